"""DataFrame -> DataFrame operators, composable with ``DataFrame.transform``."""

from .budget import BudgetedScorer, batch_costs  # noqa: F401
from .deltas import (apply_batch, delta_cycle, label_changes, net_from_deltas, read_deltas,  # noqa: F401
                     read_label_log, score_deltas)
from .extract import (attr_values, element_html, element_texts, extract_css,  # noqa: F401
                      extract_headlines, extract_items, unpaired_items, zip_items)
from .lookup import lookup_slug, seed_urls, unknown_symbols  # noqa: F401
from .merge import (align_records, combine_feeds, distinct_headlines,  # noqa: F401
                    first_occurrence, merge_day, merge_symbol_maps, merge_symbol_rows, novel, novel_firsts, to_record)
from .memo import MemoScorer, fill_memo, read_memo, recall  # noqa: F401
from .nest import day_documents, nest_day, unnest_day  # noqa: F401
from .recency import (classify_age, is_recent, is_same_day,  # noqa: F401
                      nonempty_symbols, split_recent)
from .scoring import (day_symbols, net_score, rank_scores, snapshot_map,  # noqa: F401
                      snapshot_rows, unprocessed)
from .sentiment import (IDENTITY_KEY, MATCH_KEY, LexiconScorer, PandasScorer, RecordedScorer,  # noqa: F401
                        apply_labels, conversation_messages, conversation_turns, generate_answers, label_headlines,
                        label_keys, lexicon_model, raw_answers, score_headlines, to_messages_frame)
from .variant import variant_documents, variant_records, variant_shapes  # noqa: F401
