"""Format-preserving Feistel pseudonyms for personal data (operator 6, native).

Found and validated in whole texts: payment card numbers (13 to 19 digits in one
run, or in groups of 4-4-4-4, 4-6-5 or 4-6-4; right Luhn check digit), calendar dates (``2020-02-29``,
``02/29/2020``, also before the ``T`` of a timestamp; a month above 12 is read as the day) of the years 1900 to 2099,
US social security numbers (no 000/666/9xx area, no zero group or serial),
North American phone numbers (with separators, or in one run or as 3-7 if area
and exchange begin with 2 to 9; any run of ten such digits counts as one, but
neither a part of a decimal number nor an ISBN behind ``978-``), IPv4 addresses (octets up to 255), e-mail
addresses and credentials: runs of 8 or more ASCII letters and digits, with both,
behind a word that ends in ``token``, ``key``, ``secret``, ``password``,
``passwd`` or ``pwd`` and ``=`` or ``:``.  A number that fails its check stays as
it is, and so does a hexadecimal digest without such a word.

Each value is replaced by a keyed permutation of its own format: the value is
split in two halves and each half in turn is shifted, inside its own alphabet or
range, by a keyed digest of the other (a Feistel network, ``ROUNDS`` rounds).
Such a network is one-to-one, so different values stay different, and it only
depends on the key and the value, so equal values get the same pseudonym in
every document and in every notation (``4111 1111 ...`` and ``41111111...``).
The result is valid again: the card's check digit is computed anew, dates are
permuted as day numbers 0..73048 (17 x 4297), social security numbers in
898 x 99 x 9999.  Kept: the card's first digit, a phone's country code, first
digits and a fictional 555 exchange (no other exchange becomes 555), an e-mail's domain, letters beyond ASCII,
all punctuation; a hexadecimal credential stays one.

A text is cut by one regular expression into pieces that cover it (matches,
words, the rest), pieces are mapped and joined again, so all other characters
are untouched.  All of it is SQL expressions on one row: no shuffle, no Python.

Edge cases: null text stays null, empty text empty; texts without a digit are
not cut at all; other columns pass through under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsbeam.session import lean_parser

from .common import table

ROUNDS = 8
KEY = "newsbeam-demo-key"  # a deployment passes its own secret

EMAIL = r"[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
PHONE = (r"(?:(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
         r"|(?:\+1[ .-]?|1[ -]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-]?)[2-9][0-9]{6})")
NUMBER = r"(?:[0-9]+\.[0-9]{10,11}|[0-9]{10,11}\.[0-9]+|97[89]-[0-9]{10})"  # no phone in it
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})"
NAMED = r"[A-Za-z0-9]*(?i:token|key|secret|password|passwd|pwd)[\x22']? ?[=:] ?[\x22']?"  # the word before a credential
SECRET = r"(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{8,}"
_FREE = r"(?<![\p{L}\p{N}])"  # not inside a word
_END = r"(?![\p{L}\p{N}])"
PIECES = (rf"(?s){_FREE}(?:{EMAIL}|{NAMED}{SECRET}{_END}|{NUMBER}{_END}(?!\.[0-9])|{PHONE}{_END}|{SSN}{_END}|{DATE}(?:{_END}|(?=[Tt][0-9]))"
          rf"|{IPV4}{_END}(?!\.[0-9])|{CARD}{_END})|[\p{{L}}\p{{N}}]+|[+(]|[^\p{{L}}\p{{N}}+(]+")


def _q(text: str) -> str:
    return "r'" + text.replace("'", r"\x27") + "'"


def _let(value: str, name: str, body: str) -> str:
    """Bind ``value`` once: SQL lambdas have no let."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _shift(half: str, other: str, tag: str, radix: str) -> str:
    """``half`` with every character moved inside its own alphabet by a keyed digest of ``other``."""
    stream = f"transform(sequence(0, length({half}) div 32), b -> sha2(concat({tag}, '|', b, '|', dg), 256))"
    k = "cast(conv(substring(st[j div 32], 2 * (j % 32) + 1, 2), 16, 10) as int)"  # linear in the value's length
    if radix == "hex":  # lower-case digits
        one = f"lower(hex((cast(conv(c, 16, 10) as int) + {k}) % 16))"
    else:
        one = " ".join(["CASE"] + [f"WHEN c >= '{a}' AND c <= '{z}' THEN chr({ord(a)} + (ascii(c) - {ord(a)} + {k}) % {ord(z) - ord(a) + 1})"
                                   for a, z in ("09", "az", "AZ")] + ["ELSE c END"])
    return _let(f"sha2({other}, 256)", "dg", _let(stream, "st", f"array_join(transform(split({half}, ''), (c, j) -> {one}), '')"))


def _chars(s: str, kind: str, key: str, radix: str = "alnum") -> str:
    """Feistel network over a character string; every character keeps its alphabet."""
    tag = f"concat('{key}|{kind}|', i)"
    start = f"named_struct('l', left(s0, length(s0) div 2), 'r', substring(s0, length(s0) div 2 + 1))"
    turn = (f"CASE WHEN i % 2 = 0 THEN named_struct('l', {_shift('a.l', 'a.r', tag, radix)}, 'r', a.r) "
            f"ELSE named_struct('l', a.l, 'r', {_shift('a.r', 'a.l', tag, radix)}) END")
    return _let(s, "s0", f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (a, i) -> {turn}, a -> concat(a.l, a.r))")


def _pair(left: str, right: str, m: int, n: int, kind: str, key: str, body: str) -> str:
    """Feistel network over Z_m x Z_n; ``body`` uses the result as ``p.l``, ``p.r``."""
    def f(x):
        return f"cast(conv(substring(sha2(concat('{key}|{kind}|', i, '|', {x}), 256), 1, 12), 16, 10) as bigint)"
    turn = (f"CASE WHEN i % 2 = 0 THEN named_struct('l', (a.l + {f('a.r')}) % {m}, 'r', a.r) "
            f"ELSE named_struct('l', a.l, 'r', (a.r + {f('a.l')}) % {n}) END")
    start = f"named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint))"
    return _let(f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (a, i) -> {turn})", "p", body)


def _luhn(digits: str, first_weight: int) -> str:
    """Luhn sum of a digit string, the last digit weighing ``first_weight``."""
    w = f"((j + {first_weight - 1}) % 2 + 1)"
    v = f"(cast(c as int) * {w})"
    return f"aggregate(transform(split(reverse({digits}), ''), (c, j) -> {v} div 10 + {v} % 10), 0L, (t, x) -> t + x)"


def _refill(piece: str, digits: str) -> str:
    """``piece`` with its digits replaced in order by those of ``digits``."""
    step = ("CASE WHEN c >= '0' AND c <= '9' THEN named_struct('o', concat(z.o, substring(nd, z.k, 1)), 'k', z.k + 1) "
            "ELSE named_struct('o', concat(z.o, c), 'k', z.k) END")
    return _let(digits, "nd", f"aggregate(split({piece}, ''), named_struct('o', '', 'k', 1), (z, c) -> {step}, z -> z.o)")


def pseudonym_sql(p: str, key: str = KEY) -> str:
    """SQL expression: the pseudonym of the piece ``p`` if it is a valid value, else ``p``."""
    if not key or "\\" in key or "'" in key:
        raise ValueError("the key must not be empty nor hold quotes or backslashes")
    # card: first digit kept, the rest but the check digit permuted, check digit anew
    body = f"concat(left(d, 1), {_chars('substring(d, 2, length(d) - 2)', 'card', key)})"
    card = _let(body, "pay", _refill("p", f"concat(pay, (10 - {_luhn('pay', 2)} % 10) % 10)"))
    card = f"CASE WHEN {_luhn('d', 1)} % 10 = 0 THEN {card} ELSE p END"
    # phone: t = the last ten digits, m = area (2 digits), exchange (2, none if 555), line (4); among the
    # exchanges 5xx 55 is left out (99 values), so none of them becomes the fictional one
    keep = "substring(t, 4, 3) = '555'"
    mid = "cast(substring(t, 5, 2) as int)"
    five = _pair(f"cast(substring(t, 2, 2) as int) * 99 + {mid} - CASE WHEN {mid} > 55 THEN 1 ELSE 0 END", "cast(right(t, 4) as int)", 9900, 10000, "phone5", key,
                 "format_string('%02d%02d%04d', p.l div 99, p.l % 99 + CASE WHEN p.l % 99 >= 55 THEN 1 ELSE 0 END, p.r)")
    moved = _chars(f"concat(substring(t, 2, 2), CASE WHEN {keep} THEN '' ELSE substring(t, 5, 2) END, substring(t, 7, 4))", "phone", key)
    moved = f"CASE WHEN substring(t, 4, 1) = '5' AND NOT {keep} THEN {five} ELSE {moved} END"
    phone = _let("right(d, 10)", "t", _let(moved, "m", _refill("p", (
        "concat(left(d, length(d) - 10), left(t, 1), left(m, 2), "
        f"CASE WHEN {keep} THEN '555' ELSE concat(substring(t, 4, 1), substring(m, 3, 2)) END, right(m, 4))"))))
    # social security number
    area = "cast(left(d, 3) as bigint)"
    high = f"(({area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END) * 99 + cast(substring(d, 4, 2) as bigint) - 1)"
    aout = "(p2.l div 99 + CASE WHEN p2.l div 99 >= 665 THEN 2 ELSE 1 END)"
    ssn = _pair(high, "cast(right(d, 4) as bigint) - 1", 898 * 99, 9999, "ssn", key,
                _let("p", "p2", f"format_string('%03d-%02d-%04d', {aout}, p2.l % 99 + 1, p2.r + 1)"))
    ssn = f"CASE WHEN left(d, 3) NOT IN ('000', '666') AND left(d, 1) <> '9' AND substring(d, 4, 2) <> '00' AND right(d, 4) <> '0000' THEN {ssn} ELSE p END"
    # date: iso as yyyy-mm-dd, day number since 1900-01-01
    iso = ("CASE WHEN p LIKE '____-%' THEN p WHEN substring(p, 1, 2) <= '12' THEN concat(substring(p, 7, 4), '-', substring(p, 1, 2), '-', substring(p, 4, 2)) "
           "ELSE concat(substring(p, 7, 4), '-', substring(p, 4, 2), '-', substring(p, 1, 2)) END")
    out = ("CASE WHEN q LIKE '____-%' THEN date_format(nd, 'yyyy-MM-dd') WHEN substring(q, 1, 2) <= '12' THEN date_format(nd, 'MM/dd/yyyy') "
           "ELSE CASE WHEN day(nd) > 12 THEN date_format(nd, 'dd/MM/yyyy') ELSE date_format(nd, 'MM/dd/yyyy') END END")
    num = "datediff(dt, DATE'1900-01-01')"
    moved = _pair(f"{num} div 4297", f"{num} % 4297", 17, 4297, "date", key,
                  _let("date_add(DATE'1900-01-01', cast(p.l * 4297 + p.r as int))", "nd", out))
    date = _let("p", "q", _let(f"try_to_timestamp({iso}, 'yyyy-MM-dd')", "ts", _let("cast(ts as date)", "dt",
                f"CASE WHEN dt BETWEEN DATE'1900-01-01' AND DATE'2099-12-31' THEN {moved} ELSE q END")))
    # IPv4 as two 16-bit halves
    o = _let("transform(split(p, '[.]'), x -> cast(x as bigint))", "o", (
        "CASE WHEN forall(o, x -> x <= 255) THEN " + _pair("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", 65536, 65536, "ip", key,
        "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)") + " ELSE ip0 END"))
    ipv4 = _let("p", "ip0", o)
    local = "substring_index(p, '@', 1)"
    az, up, nine = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    turned = "".join(x[1:] + x[0] for x in (az, up, nine))  # one character is only rotated, under some keys by nothing
    moved = _let(_chars(local, "email", key), "e", f"CASE WHEN length(e) = 1 AND e = left(p, 1) THEN translate(e, '{az + up + nine}', '{turned}') ELSE e END")
    email = f"concat({moved}, '@', substring_index(p, '@', -1))"
    hexed = _let(_chars("lower(v)", "hex", key, "hex"), "h", "CASE WHEN v = upper(v) THEN upper(h) ELSE h END")
    secret = _let("regexp_extract(p, '[A-Za-z0-9]+$', 0)", "v", (
        f"concat(left(p, length(p) - length(v)), CASE WHEN v RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN {hexed} ELSE {_chars('v', 'secret', key)} END)"))
    digits = _let("regexp_replace(p, '[^0-9]', '')", "d", (
        f"CASE WHEN p RLIKE {_q('^' + SSN + '$')} THEN {ssn} "
        f"WHEN p RLIKE {_q('^' + PHONE + '$')} THEN {phone} "
        f"WHEN p RLIKE {_q('^' + DATE + '$')} THEN {date} "
        f"WHEN p RLIKE {_q('^' + IPV4 + '$')} THEN {ipv4} "
        f"WHEN p RLIKE {_q('^' + CARD + '$')} THEN {card} ELSE p END"))
    expr = (f"CASE WHEN length(p) < 5 THEN p WHEN p RLIKE {_q('^' + EMAIL + '$')} THEN {email} "
            f"WHEN p RLIKE {_q('^' + NAMED + SECRET + '$')} THEN {secret} "
            f"WHEN p RLIKE '^[0-9+(][0-9+() ./-]+[0-9]$' THEN {digits} ELSE p END")
    return f"element_at(transform(array({p}), p -> {expr}), 1)" if p != "p" else expr


def pseudonymise(df: DataFrame, text: str = "text", key: str = KEY, count: str | None = None) -> DataFrame:
    """``df`` with the personal data of ``text`` replaced; ``count`` names an
    extra column with the number of values replaced."""
    t = f"`{text}`"
    cut = f"CASE WHEN {t} RLIKE '[0-9@]' THEN regexp_extract_all({t}, {_q(PIECES)}, 0) END"
    out = df.withColumn("__pii_pieces", F.expr(cut))
    with lean_parser(df.sparkSession):
        out = out.withColumn("__pii_new", F.expr(f"transform(__pii_pieces, p -> {pseudonym_sql('p', key)})"))
    changed = F.coalesce(F.size(F.filter(F.zip_with("__pii_pieces", "__pii_new", lambda a, b: a != b), lambda x: x)), F.lit(0))
    changed = F.when(F.col("__pii_pieces").isNull(), F.lit(0)).otherwise(changed)
    cols = [F.coalesce(F.array_join("__pii_new", ""), F.col(text)).alias(text) if c == text else F.col(c) for c in df.columns]
    return out.select(*cols, *([changed.alias(count)] if count else []))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms in place: doc_id, text, replaced (values replaced)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, "text", count="replaced")
