"""Column -> Column scalars (native Spark expressions)."""

from .answers import (parse_answer, render_prompt, to_label, to_messages)  # noqa: F401
from .dates import (as_of_lit, day_key_text, day_of, parse_day_text,  # noqa: F401
                    snapshot_time_text)
from .keys import digest  # noqa: F401
from .text import (decode_entities, element_text, first_line, first_word,  # noqa: F401
                   first_word_int, host_of, remove_tags, strip_ws)
