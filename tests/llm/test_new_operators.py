"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from newsbeam.llm import alignment, difference_cover, spelling, suffix_dedup
from newsbeam.llm.registry import QUERIES
from tests.conftest import SF01, SF001

from .test_operators import edge_docs

# --------------------------------------------------------------------------- suffix array


def test_difference_cover_orders_suffixes(spark):
    rng = random.Random(5)
    strings = {s: [rng.randint(1, 2) for _ in range(rng.choice([1, 2, 3, 5, 31, 60]))] for s in range(8)}
    strings[8], strings[9] = [1] * 40, list(strings[3])  # one letter only; a string that occurs twice
    rows = [(s, j, c, 1, 1) for s, x in strings.items() for j, c in enumerate(x)]
    df = spark.createDataFrame(rows, "sid long, j long, name long, step long, span long")
    for depth in (1000, 6):
        rank = {(r.sid, r.j): r["rank"] for r in difference_cover.suffix_ranks(df, depth).collect()}
        assert len(rank) == len(rows)
        order = sorted(rank, key=rank.get)
        texts = [strings[s][j:][:depth] for s, j in order]
        assert texts == sorted(texts)


def brute_removed(docs):
    """Per document (bytes, removed, spans, digest) by a table of all 100-byte strings."""
    first, out = {}, {}
    for key, text in docs:
        raw = (text or "").encode()
        for p in range(len(raw) - 99):
            first.setdefault(raw[p:p + 100], (key, p))
    for key, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if first[raw[p:p + 100]] != (key, p):
                gone[p:p + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[key] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shared_passages(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(80, 400))) for _ in range(12)] + ["a" * 300, "ab" * 200]
    for d in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            p = p[rng.randrange(len(p)):] if rng.random() < .5 else p
            i = rng.randrange(len(p) + 1)
            parts.append(p[:i] + rng.choice("xyz") + p[i:] if rng.random() < .3 else p)
            parts.append("".join(rng.choice("ab cdef") for _ in range(rng.randint(0, 60))))
        yield d * 3, "".join(parts) if rng.random() > .03 else None


@pytest.mark.parametrize("flush", [suffix_dedup.FLUSH, 20])
def test_repeats_are_removed(spark, monkeypatch, flush):
    monkeypatch.setattr(suffix_dedup, "FLUSH", flush)  # the functions shipped to tasks take it from here
    docs = [*shared_passages(7, 90), (1000, "a" * 5000), (1001, "z" * 99), (1002, "")]
    docs.append((999, docs[5][1]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute_removed(sorted(docs))


def test_repeats_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_suffix_dedup"](spark, SF001).collect()}
    want = brute_removed(docs)
    assert got == want and sum(x[1] for x in want.values()) > 0


def test_repeated_ids_are_documents_of_their_own(spark):
    text = "".join(random.Random(3).choices("abcdefghij", k=150))
    rows = spark.createDataFrame([(None, text), (None, text), (4, text), (4, "x" + text), (5, None)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(rows).collect())
    assert got == sorted([(150, 0), (150, 150), (150, 150), (151, 150), (0, 0)])


# --------------------------------------------------------------------------- spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def test_search_schemes_find_each_pair_once():
    rng = random.Random(11)
    for _ in range(8):
        words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(120)} | {"a" * k for k in range(7, 12)}
        df = pd.DataFrame({"word": sorted(words), "n": [rng.randint(2, 50) for _ in words]})
        n = dict(zip(df["word"], df["n"]))
        count, best = Counter(), defaultdict(list)
        for side in ("first", "last"):
            for r in spelling.near_in_group(side, df, df).itertuples():
                count[r.word] += r.n_near
                best[r.word].append((-r.best_n, r.best))
        for w in words:
            want = [u for u in words if near(w, u)]
            assert count[w] == len(want)
            assert min(best[w], default=None) == min(((-n[u], u) for u in want), default=None)


def brute_words(docs):
    out = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("index_chars", [spelling.INDEX_CHARS, 3000])
def test_variants_of_documents(spark, index_chars):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    words = brute_words([tuple(r) for r in docs.collect()])
    by_cut = defaultdict(set)  # words that are equal without one character
    for w in words:
        for k in range(len(w)):
            by_cut[w[:k] + w[k + 1:]].add(w)
    pairs = defaultdict(set)
    for cut, group in by_cut.items():
        for a in group | ({cut} & set(words)):
            pairs[a] |= {b for b in group | ({cut} & set(words)) if a != b and near(a, b)}
    form = {}
    for w, others in pairs.items():
        if others:
            m, u = min((-words[u], u) for u in others)
            if -m >= 10 * words[w]:
                form[w] = u

    def root(w):
        while w in form:
            w = form[w]
        return w
    want = {w: (form.get(w), root(w), n, len(pairs[w]), words[form[w]] if w in form else None) for w, n in words.items()}
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs, index_chars).collect()}
    assert got == want and form


def test_chains_of_forms_end_at_the_root(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w9" for w, _ in chain}


def test_long_runs_are_cut_at_their_end(monkeypatch):
    text = "Wordword " * 50 + "x" * 500 + " Wordword"
    whole = spelling.document_words(3, text)
    monkeypatch.setattr(spelling, "SLICE", 13)
    assert spelling.document_words(3, text) == whole


# --------------------------------------------------------------------------- tokenizer alignment


ODD_TEXTS = ["", None, " a  b\n c", "x▁y", "end \n ", " \n a\n\n b", "ﬁ<s></s><|endoftext|> ŭ  　y\x00z", "\n", "   ", "日本語 テキスト",
             "a  b  c", " a", "a ", "tab\t word\t\tx  \t y", "word.\nNext", "a\n", "\n\n", "a \n b", "a\r\n b"]


def whole_ids(pair, text):
    """Ids of both tokenizers over a whole text, or nothing if one does not spell it."""
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    spelt = b"".join(pair.bytes_a[i] for i in a) == raw and b"".join(pair.bytes_b[i] for i in b) == raw
    return (a, b) if spelt else None


def brute_alignment(pair, texts):
    """Links as id pairs and groups by walking both sequences."""
    out = []
    for text in texts:
        ids = whole_ids(pair, text)
        if ids is None:
            out.append((0, 0, 0, [], ""))
            continue
        sides = []
        for side, table in zip(ids, (pair.bytes_a, pair.bytes_b)):
            at, rows = 0, []
            for i in side:
                rows.append((at, at + len(table[i]), i))
                at += len(table[i])
            sides.append(rows)
        a, b = sides
        links, k = [], 0
        for lo, hi, i in a:
            while b[k][1] <= lo:
                k += 1
            m = k
            while m < len(b) and b[m][0] < hi:
                links.append((i, b[m][2]))
                m += 1
        groups, ia, ib = [], 0, 0
        for end in sorted({x[1] for x in a} & {x[1] for x in b}):
            ga, gb = [], []
            while ia < len(a) and a[ia][1] <= end:
                ga.append(str(a[ia][2]))
                ia += 1
            while ib < len(b) and b[ib][1] <= end:
                gb.append(str(b[ib][2]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        out.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*alignment._paths(None, None))


def test_words_are_encoded_as_whole_texts(spark, pair):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").limit(150).collect()]
    for text in texts:
        words = alignment.words_of(text) if text else []
        assert "".join(words) == (" " + text if text else "")
        number = pair.encode(words)
        good = bool(words) and bool(pair.good[number].all())
        want = whole_ids(pair, text)
        assert good == (want is not None)
        if good:
            assert (pair.tokens(0, number)[0].tolist(), pair.tokens(1, number)[0].tolist()) == want


def test_new_words_are_encoded_together(pair, monkeypatch):
    class Counting:
        def __init__(self, tok):
            self.tok, self.texts = tok, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tok.encode_batch_fast(texts, **options)
    own = alignment.Pair(*alignment._paths(None, None))
    own.a = Counting(own.a)
    words = [f" w{i}" for i in range(2000)] + ["\nline", "\n", " ", " tail \t", " x▁y", " ﬁ", " 日本語", "  two"]
    number = own.encode(words)
    assert own.a.texts < 200
    for word, n in zip(words, number.tolist()):
        ids = pair.a.encode(word, add_special_tokens=False).ids
        assert own.tokens(0, np.array([n]))[0].tolist() == ids
        want = whole_ids(pair, word[1:]) if word[0] == " " and word[1:] else None
        if want:
            assert own.good[n] and own.tokens(1, np.array([n]))[0].tolist() == want[1]
    assert not own.good[number[words.index(" x▁y")]] and own.good[number[:2000]].all()
    # a token across a cut: both words are encoded singly
    monkeypatch.setattr(own, "len_a", own.len_a + 1)
    monkeypatch.setattr(own, "_spelt", lambda texts, flat, sizes: np.ones(len(texts), bool))
    number = own.encode([" new", " words"])
    assert [own.tokens(0, number[k:k + 1])[0].tolist() for k in (0, 1)] == [pair.a.encode(w, add_special_tokens=False).ids for w in (" new", " words")]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_and_counts(spark, pair, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    aligned = alignment.stage(alignment.align_documents(docs), "aligned")
    got = {r.doc_id: r for r in alignment.score_links(aligned).collect()}
    want = brute_alignment(pair, texts)
    count = Counter(link for x in want for link in x[3])
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    for k, (n_a, n_b, n_groups, links, digest) in enumerate(want):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, len(links), digest)
        assert (r.n_best, r.count_sum) == (sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links))


# --------------------------------------------------------------------------- edge cases of all three


def test_edges_and_empty_tables(spark):
    for docs in (edge_docs(spark), edge_docs(spark).limit(0)):
        n = docs.count()
        assert suffix_dedup.remove_repeats(docs).count() == n
        assert alignment.score_links(alignment.stage(alignment.align_documents(docs), "aligned")).count() == n
        spelling.variants(docs).collect()
