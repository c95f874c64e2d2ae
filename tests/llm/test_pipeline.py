"""The pipeline's rows against what each stage must keep."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as cp
from newsbeam.llm import chosen_path, mixing, packing, pseudonyms, toxicity
from tests.conftest import SF001

from .test_operators import brute_classes, edge_docs


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = cp.drop_toxic(spark, docs, SF001)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.orderBy("doc_id").collect()]
    ids = [r.doc_id for r in kept.orderBy("doc_id").collect()]
    cls, _ = brute_classes(texts)
    single = cp.drop_near_duplicates(spark, kept, SF001)
    assert {r.doc_id for r in single.collect()} == {ids[c] for c in set(cls)}
    hidden = cp.hide_personal_data(spark, single, SF001)
    assert hidden.columns == docs.columns and hidden.count() == single.count()
    mixed = cp.mix_sources(spark, hidden, SF001)
    assert mixed.columns == docs.columns
    packed = cp.pack(spark, mixed, SF001)
    assert packed.groupBy("sequence_id").sum("length").toDF("s", "n").where("n > 4096").count() == 0
    assert packed.where("piece = 0").count() == mixed.count()


def _mix(docs):
    """``(doc_id, source, text)`` -> ``(doc_id, text)`` as often as taken, step by step."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, _, t in docs}
    sources = sorted({s for _, s, _ in docs if s is not None}) + [None] * any(s is None for _, s, _ in docs)
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(sources)}
    held = {s: sum(size[d] for d, x, _ in docs if x == s) for s in sources}
    left, target, todo = float(sum(held.values())), {}, set(sources)
    while todo:
        share = {s: left * weight[s] / sum(weight[x] for x in todo) for s in todo}
        over = {s for s in todo if share[s] > 3 * held[s]}
        for s in over or todo:
            target[s] = 3.0 * held[s] if over else share[s]
        left -= sum(target[s] for s in over)
        todo = todo - over if over else set()
    out = []
    for s in sources:
        t = int(target[s] + 0.5)
        whole, rest = divmod(t, held[s]) if held[s] else (0, 0)
        for _, d, text in sorted((hashlib.md5(f"0:{d}".encode()).hexdigest(), d, x) for d, y, x in docs if y == s):
            out += [(d, text)] * whole
            part = max(0, min(size[d], rest))
            rest -= size[d]
            if part:
                out.append((d, text if part == size[d] else "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)[:part])))
    return out


def test_run_follows_a_plain_version(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = cp.drop_toxic(spark, docs, SF001).orderBy("doc_id").collect()  # the model's own test is in test_operators
    classes, _ = brute_classes([r.text for r in kept])
    single = {kept[c].doc_id for c in set(classes)}
    hidden = pseudonyms.pseudonymise(docs.select("doc_id", "source", "text")).collect()
    copies = _mix([(r.doc_id, r.source, r.text) for r in hidden if r.doc_id in single])
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, sizes = Counter(), []
    for d, text in copies:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at:at + 4096]
            want[d, n, at, len(cut), zlib.crc32(np.asarray(cut, "<u4").tobytes())] += 1
            sizes.append(len(cut))
    got = cp.run(spark, SF001).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert packing.lower_bound(sizes, 4096) <= len(places) <= len(packing.best_fit_decreasing(sizes, 4096))


def test_stages_survive_edges(spark):
    for docs in (edge_docs(spark), edge_docs(spark).limit(0)):
        for _, step in cp.STAGES:
            docs = step(spark, docs, SF001)
            docs.collect()


def test_modules_are_used():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    assert all(m for m in (chosen_path, mixing, packing, pseudonyms, toxicity))
