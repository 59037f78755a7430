"""The training-data operators against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    decontaminate, html_render, licenses, lm_scoring, mixing, ngram_join, quality_classifier, quality_rules,
    suffix_dedup, warc,
)
from tidemark.llm.groups import components
from tidemark.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = [f"w{chr(97 + i % 26)}{i}é" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(VOCABULARY[i] for i in rng.integers(0, 400, n))


@pytest.fixture(scope="module")
def docs(spark):
    base, passage = prose(1, 120), prose(2, 80)
    edited = base.split()
    edited[60] = "other"
    rows = [
        (1, base), (2, base), (3, " ".join(edited)), (4, prose(4, 90) + "\n" + passage + "\n" + prose(5, 40)),
        (5, passage + " " + prose(6, 70)), (6, None), (7, ""), (8, " \n\t"), (9, "one two"), (9, "one two"),
        (10, "spam " * 300), (11, prose(11, 30_000)), (None, prose(12, 60)), (12, "### $$$ " * 60),
        (13, prose(13, 60) + "\nReleased under the MIT License.\n" + prose(14, 5)),
    ]
    return spark.createDataFrame(
        [(i, t, "en", f"s{k % 3}" if k else None, len(t or ""), "x", "y") for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, gone string, root string",
    )


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, prose(2, 80)), (2, "one two"), (3, None), (4, ""), (5, prose(99, 40))], "item_id long, text string"
    )


def words(text):
    return WORD.findall((text or "").encode().lower())


def test_matched_prefix_is_the_longest_with_the_recall():
    length = ngram_join.matched_prefix(32, 8, 0.8, 0.9999)
    assert 1 - (1 - 0.8**length) ** 32 >= 0.9999 > 1 - (1 - 0.8 ** (length + 1)) ** 32
    with pytest.raises(ValueError):
        ngram_join.matched_prefix(1, 8, 0.8, 0.9999)


@pytest.mark.parametrize("block", [2, 1024])
def test_near_duplicates(docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    got = {(r.doc_id, r.class_id, r.n_links) for r in ngram_join.near_duplicates(docs).collect()}
    assert {(1, 1, 2), (2, 1, 2), (3, 1, 2), (9, 9, 1), (4, 4, 0), (6, 6, 0), (None, None, 0)} <= got
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


def test_components_of_chains_and_none(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (5, 5)], "a long, b long")
    assert {(r.node, r.root) for r in components(links, "a", "b").collect()} == (
        {(i, 0) for i in range(41)} | {(90, 90), (91, 90)}
    )
    assert components(links.limit(0), "a", "b").isEmpty()


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("kinds", [1, 20_000])
def test_repeats_by_brute_force(docs, monkeypatch, keep_first, kinds):
    monkeypatch.setattr(suffix_dedup, "KINDS_PER_TASK", kinds)
    size = 50
    rows = docs.filter("doc_id IS NOT NULL AND doc_id <> 11").dropDuplicates(["doc_id"])
    texts = {r.doc_id: (r.text or "").encode() for r in rows.collect()}
    count, first = Counter(), {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - size + 1):
            w = texts[i][p : p + size]
            count[w] += 1
            first.setdefault(w, (i, p))
    for r in suffix_dedup.without_repeats(rows, min_bytes=size, keep_first=keep_first).collect():
        data = texts[r.doc_id]
        mark = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - size + 1):
            w = data[p : p + size]
            if count[w] > 1 and not (keep_first and first[w] == (r.doc_id, p)):
                mark[p : p + size] = True
        kept = bytes(b for b, m in zip(data, mark) if not m)
        runs = int((mark[1:] < mark[:-1]).sum())
        assert (r.dedup_bytes, r.dedup_removed, r.dedup_spans, r.dedup_sha256) == (
            len(data), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()
        ), r.doc_id


def covered(text: bytes, count: Counter, size: int) -> np.ndarray:
    mark = np.zeros(len(text) + 1, bool)
    for p in range(len(text) - size + 1):
        if count[text[p : p + size]] > 1:
            mark[p : p + size] = True
    return mark


@pytest.mark.parametrize("kinds", [1, 20_000])
def test_passages_below_the_cut_by_brute_force(docs, monkeypatch, kinds):
    monkeypatch.setattr(suffix_dedup, "KINDS_PER_TASK", kinds)
    rows = docs.filter("doc_id IS NOT NULL AND doc_id <> 11").dropDuplicates(["doc_id"])
    joined = prose(31, 5)
    more = [(20, prose(21, 20) + " " + joined + " " + prose(22, 20)), (21, joined + prose(23, 9)), (22, prose(2, 80)[:45] + prose(1, 9))]
    rows = rows.select("doc_id", "text").union(rows.sparkSession.createDataFrame(more, "doc_id long, text string"))
    texts = {r.doc_id: (r.text or "").encode() for r in rows.collect()}
    count = Counter(t[p : p + n] for t in texts.values() for n in (30, 50) for p in range(len(t) - n + 1))
    found = suffix_dedup.without_repeats(rows, min_bytes=50, keep_first=False, passage_bytes=30).collect()
    assert len(found) == len(texts) and any(0 < r.dedup_passages and not r.dedup_removed for r in found)
    for r in found:
        data = texts[r.doc_id]
        long, short = (covered(data, count, n) for n in (50, 30))
        kept = bytes(b for b, m in zip(data, long) if not m)
        assert (r.dedup_bytes, r.dedup_removed, r.dedup_spans, r.dedup_sha256, r.dedup_passages) == (
            len(data), int(long.sum()), int((long[1:] < long[:-1]).sum()), hashlib.sha256(kept).hexdigest(),
            int(short.sum()),
        ), r.doc_id


def test_passages_of_fifty_words_are_reported(spark, tmp_path):
    passage = " ".join(f"w{i:02d}é" for i in range(51))
    assert 240 <= len(passage.encode()) < 400
    texts = [prose(1, 60) + " " + passage, passage + " " + prose(2, 60), prose(3, 90), None, "short"] + [prose(7, 90)] * 2
    table = spark.createDataFrame([(i if i < 6 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op6_suffix_dedup"](spark, str(tmp_path)).collect()}
    same = len(prose(7, 90).encode())
    assert {i: r.n_removed for i, r in got.items()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: same, None: same}
    # A blank of either side may repeat with the passage.
    assert all(0 <= got[i].n_passage_bytes - len(passage.encode()) <= 2 for i in (0, 1))
    assert [got[i].n_passage_bytes for i in (2, 3, 4, 5, None)] == [0, 0, 0, same, same]
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(table, passage_bytes=240)
    with pytest.raises(ValueError):
        suffix_dedup.without_repeats(table, min_bytes=100, keep_first=False, passage_bytes=240)


@pytest.mark.parametrize("slice_bytes", [10, 1 << 20])
def test_contamination_by_brute_force(docs, items, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(decontaminate, "_CANDIDATES", 1 if slice_bytes < 1 << 20 else 1 << 19)
    windows = {}
    for r in items.collect():
        w = words(r.text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(r.item_id))
    expected = []
    for r in docs.collect():
        w, hit, ids = words(r.text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= found
        expected.append((r.doc_id, len(w), len(hit), sorted(ids)))
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.contamination(docs, items).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_proximity(spark):
    table = spark.createDataFrame([(1, "a x b y c"), (2, "c b a"), (3, "a z z z z z b c")], "doc_id long, text string")
    query = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    index = decontaminate.build_index(table)
    rows = decontaminate.proximity_matches(index, query, slack=2).collect()
    assert sorted((r.doc_id, r.start, r.end) for r in rows) == [(1, 0, 5), (2, 0, 3)]


def test_rules_and_ablation(docs):
    rows = quality_rules.apply_policy(quality_rules.ledger(docs), "v3")
    got = {r.doc_id: r for r in rows.collect()}
    assert got[6].n_words == got[7].n_words == got[8].n_words == 0 and got[6].base_failed
    assert got[10].n_repeat_words == 300 and not got[10].kept
    assert got[12].n_symbols == 360 and got[1].kept and got[11].kept
    table = {(r.policy, r.rule): (r.n_failed, r.n_only) for r in quality_rules.ablation(rows).collect()}
    assert table["v1", "repeated_words"] == (2, 2)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id IS NULL").count() == 1


def test_licenses(docs):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[13].base_labels, got[13].labels, got[13].score) == ("mit", "mit", 1.0)
    assert (got[13].first_word, got[13].last_word, got[13].n_base) == (61, 61, 1)
    assert got[6].labels == "" and got[6].first_word is None and got[6].score == 0


def test_wrapped_notices_by_brute_force(spark):
    plain = [(label, prose(30 + i, 50) + "\n\n" + text + "\n\n" + prose(60 + i, 50)) for i, (label, text) in enumerate(licenses.TEMPLATES)]
    texts = [text for _, text in plain]
    texts += ["\n".join(mark + x for x in textwrap.wrap(text, width)) for _, text in plain for mark, width in (("", 72), (" * ", 40))]
    # Scattered words and half a notice stay without a label.
    mit = licenses.TEMPLATES[0][1].split()
    texts += [" ".join(mit[:13]), "\n".join(w + " " + prose(i, 12) for i, w in enumerate(mit)), ("\n".join(mit) + "\n") * 50]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    width = max(len(words(text)) for _, text in licenses.TEMPLATES)
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.scan(table, phrases={}).collect()}
    for i, text in enumerate(texts):
        own = words(text)
        blocks = [set(words(line)) for line in text.split("\n")]
        blocks += [set(own[k : k + width]) for k in range(len(own))]
        labels, score = set(), 0.0
        for label, template in licenses.TEMPLATES:
            held = set(words(template))
            share = max(len(held & b) for b in blocks) / len(held)
            if share >= 0.8 - 1e-9:
                labels.add(label)
                score = max(score, share)
        assert got[i] == (",".join(sorted(labels)), round(score, 9))
    for k, (label, _) in enumerate(plain):
        n = len(plain)
        assert all(label in got[i][0].split(",") for i in (k, n + 2 * k, n + 2 * k + 1))
    assert got[len(texts) - 3][0] == got[len(texts) - 2][0] == "" and got[len(texts) - 1][0] == "mit"


def test_archives_round_trip(spark):
    body = "WARC/1.1\r\n\r\n" + "é" * 60
    pages = spark.createDataFrame(
        [(2, "u\r\nv", body), (1, "u", body), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", ""),
         (7, "u", body + "x"), (7, "u", body + "x")],
        "page_id long, url string, html string",
    )
    got = sorted(map(tuple, warc.archived(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=repr)
    size = len(body.encode())
    assert got == sorted([
        (1, size, "response", None), (2, size, "revisit", 1), (3, 5, "response", None), (4, 5, "response", None),
        (5, 0, "response", None), (None, 0, "response", None), (7, size + 1, "response", None),
        (7, size + 1, "revisit", 7),
    ], key=repr)


def test_mixture_meets_its_targets(spark):
    rows = [(i, prose(i, 20 + i % 30), "abc"[i % 3] if i % 7 else None, "xy"[i % 2]) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    dimensions = {"source": F.col("source"), "lang": F.col("lang")}
    cells = mixing.count_cells(table, dimensions, mixing.token_count(F.col("text")))
    targets = {n: mixing.tempered_targets(cells, n) for n in dimensions}
    raked = mixing.rake(cells, targets)
    for name, target in targets.items():
        sums = {r[0]: r[1] for r in raked.groupBy(name).agg(F.sum("weight")).collect()}
        for r in target.collect():
            assert sums[r.value] == pytest.approx(r.share, abs=1e-8)
    drawn = mixing.calibrated(raked, 0.5)
    row = drawn.agg(F.sum(F.col("__tokens") * F.col("probability")), F.sum("__tokens")).first()
    assert row[0] == pytest.approx(row[1] / 2, rel=1e-9)
    sample = mixing.mixed_sample(table)
    assert 100 < sample.count() < 300 and sample.columns[:4] == table.columns
    assert mixing.mixed_sample(table.limit(0)).isEmpty()


def test_classifier_learns_and_scores_everything(spark, docs):
    good = [(i, prose(i, 80), 1) for i in range(100, 160)]
    bad = [(i, " ".join(w + "###" for w in prose(i, 80).split()), 0) for i in range(200, 260)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    held = quality_classifier.fold(F.col("doc_id"), 5) == 0
    model = quality_classifier.fit(table, table.filter(~held))
    rows = quality_classifier.score(table, model).join(table, "doc_id").filter(held).collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(docs, model).collect())
    empty = quality_classifier.fit(table, table.limit(0))
    assert {r.score for r in quality_classifier.score(docs, empty).collect()} == {0.5}


def test_base_scores_by_brute_force(docs):
    held = quality_classifier.fold(F.col("doc_id"), 10) == 0
    rows, counts = docs.collect(), Counter()
    for r in rows:
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10:
            counts.update((r.text or "").encode().lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r in rows:
        tokens = [*(r.text or "").encode().lower().split(), None]
        score = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        expected.append((r.doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(score, 5)))
    got = [
        (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))
        for r in lm_scoring.base_scores(docs, held).collect()
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_base_scores_deal_a_frequent_word_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_CHUNK_BYTES", 2000)
    texts = ["the " * 400 + w for w in prose(21, 60).split()]
    table = pa.table({
        "doc_id": range(60), "text_hash": range(60), "held_out": [i % 10 == 0 for i in range(60)],
        "bytes": pa.array([t.encode() for t in texts], pa.binary()),
    })
    monkeypatch.setattr(lm_scoring, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rows = pa.Table.from_batches(lm_scoring._packer(8)(iter(table.to_batches()))).to_pandas()
    sent, kept = rows[rows["bucket"].notna()], rows[rows["bucket"].isna()]
    # A bucket gets one entry per chunk and word, however often and in however many texts the word stands.
    assert len(kept) > 20 and sent[["sizes", "texts", "times"]].isna().all(axis=None)
    assert sum(map(len, sent["terms"])) <= 8 * (len(kept) + 60)
    counted = pd.concat([lm_scoring._bucket_counts(g) for _, g in sent.groupby("bucket")])
    assert counted["tokens"].sum() == sum(len(t.split()) for i, t in enumerate(texts) if i % 10)
    got = pd.concat(
        lm_scoring._chunk_rows(0.0, False)(pd.concat([k.to_frame().T, counted[counted["chunk"] == k["chunk"]]]))
        for _, k in kept.iterrows()
    ).set_index("doc_id")
    counts = Counter(w for i, t in enumerate(texts) if i % 10 for w in t.split())
    for i, t in enumerate(texts):
        assert got.loc[i, "total"] == pytest.approx(sum(math.log10(counts[w] + 0.1) for w in t.split()))
        assert got.loc[i, "n_known"] == sum(counts[w] > 0 for w in t.split())


def test_model_is_causal_normalised_and_scores_each_token_once(docs):
    model = lm_scoring.fit(docs)
    p, vocabulary, end = lm_scoring._unpacked(model.parameters), model.vocabulary, model.tokenizer.end
    neighbours, buckets = model.neighbours, vocabulary.buckets
    # After any id, the ids of a class add up to one; so do the classes' priors.
    for before in (end, 0, 17):
        own = 10 ** (neighbours.share + neighbours.within[buckets[before], buckets])
        mass = np.bincount(vocabulary.classes, own)
        assert mass[mass > 0] == pytest.approx(1, rel=1e-4)
    np.testing.assert_allclose(np.exp(neighbours.prior).sum(axis=1), 1, rtol=1e-4)
    rng = np.random.default_rng(3)
    ids = rng.integers(0, end, 100)
    inputs, target = vocabulary.inputs[np.append(end, ids)[None, :32]], vocabulary.classes[ids[None, :32]]
    prior, previous = neighbours.prior, buckets[np.append(end, ids)[None, :32]]
    wanted = np.ones((1, 32), bool)
    base = lm_scoring.log_probabilities(p, inputs, prior, previous, target, wanted)
    later = inputs.copy()
    later[0, 20:] = 0
    np.testing.assert_allclose(base[:20], lm_scoring.log_probabilities(p, later, prior, previous, target, wanted)[:20], rtol=1e-4)
    mass = sum(10 ** lm_scoring.log_probabilities(p, inputs, prior, previous, np.full((1, 32), c), wanted) for c in range(lm_scoring.CLASSES))
    np.testing.assert_allclose(mass, 1, rtol=1e-4)
    # Window by window, each token from the window that shows it the most context.
    sequence = np.append(ids, end)
    before, total = np.append(end, ids), 0.0
    for t in range(len(sequence)):
        k = max(0, -(-(t + 1 - lm_scoring.CONTEXT) // lm_scoring.STRIDE))
        at = np.minimum(k * lm_scoring.STRIDE + np.arange(32), len(sequence) - 1)
        one = np.arange(32)[None] == t - k * lm_scoring.STRIDE
        total += lm_scoring.log_probabilities(
            p, vocabulary.inputs[before[at]][None], prior, buckets[before[at]][None],
            vocabulary.classes[sequence[at]][None], one,
        )[0]
        total += neighbours.share[sequence[t]] + neighbours.within[buckets[before[t]], buckets[sequence[t]]]
    got = lm_scoring._text_scores(model, p, ids, np.array([0, 100]))
    assert got[0] == pytest.approx(total, rel=1e-4)
    scores = {r.doc_id: r.score for r in lm_scoring.score(docs, model).collect()}
    assert scores[6] == scores[7] == scores[8] < 0 and scores[11] < scores[1]
    # Without any counts every id stays possible.
    pairs = np.zeros((lm_scoring.BUCKETS, lm_scoring.BUCKETS))
    plain = lm_scoring.Neighbours.from_counts(np.zeros(end + 1), pairs, vocabulary)
    assert np.isfinite(plain.share).all() and np.isfinite(plain.within).all()


def test_model_is_fitted_on_all_ids(spark, monkeypatch):
    # The word of the long text's last third lies outside the middles of its pieces of 16 KB.
    texts = ["alpha " * 1000 + "omega " * 500, "short one", "", None, prose(7, 300)]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    tokenizer = lm_scoring.Tokenizer.load()
    encoder, end, expected = tokenizer.encoder(), tokenizer.end, Counter()
    for t in texts:
        data = (t or "").encode()
        ids, _ = encoder.ids(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        expected.update([*ids.tolist(), end])
    seen = []
    plain = lm_scoring.Vocabulary.from_counts
    monkeypatch.setattr(lm_scoring.Vocabulary, "from_counts", lambda counts: seen.append(counts.copy()) or plain(counts))
    model = lm_scoring.fit(table, rounds=0)
    assert {i: int(n) for i, n in enumerate(seen[0]) if n} == expected
    # A round takes each id once as a target, with the ids truly before it.
    taken = []
    monkeypatch.setattr(
        lm_scoring, "_gradient",
        lambda p, inputs, prior, before, target, wanted: taken.extend(zip(before[wanted], target[wanted]))
        or np.zeros_like(model.parameters),
    )
    rows = spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "bytes binary").toArrow()
    sequences = list(lm_scoring._sequences(tokenizer)(iter(rows.to_batches())))
    vocabulary = model.vocabulary
    list(lm_scoring._trainer(model.parameters, vocabulary, model.neighbours.prior, end, 0, 1)(iter(sequences)))
    pairs = Counter()
    for t in texts:
        data = (t or "").encode()
        ids, _ = encoder.ids(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        ids = [end, *ids.tolist(), end]
        pairs.update((vocabulary.buckets[a], vocabulary.classes[b]) for a, b in zip(ids[:-1], ids[1:]))
    assert Counter(taken) == pairs


def test_later_windows_compute_the_places_they_are_wanted_for(monkeypatch):
    overlap = lm_scoring.CONTEXT - lm_scoring.STRIDE
    sizes, places = np.array([1, 100, 33, 32, 250]), []
    for _, index, wanted in lm_scoring._windows(sizes, 3):
        first = wanted[:, :overlap].any(axis=1)
        assert first.all() or not first.any()
        places.extend(index[wanted])
    assert sorted(places) == list(range(sizes.sum()))
    rng = np.random.default_rng(4)
    tokenizer = lm_scoring.Tokenizer.load()
    counts = rng.integers(0, 50, tokenizer.end + 1).astype(float)
    vocabulary = lm_scoring.Vocabulary.from_counts(counts)
    pairs = rng.integers(0, 3, (lm_scoring.BUCKETS, lm_scoring.BUCKETS)).astype(float)
    model = lm_scoring.Model(
        tokenizer, vocabulary, lm_scoring.Neighbours.from_counts(counts, pairs, vocabulary), lm_scoring.initial()
    )
    p, attended, asked = lm_scoring._unpacked(model.parameters), lm_scoring._attended, []

    def watched(*args):
        found = attended(*args)
        asked.append(found[-1].shape[-1])
        return found

    monkeypatch.setattr(lm_scoring, "_attended", watched)
    texts = [rng.integers(0, tokenizer.end, n - 1) for n in sizes]
    together = lm_scoring._text_scores(model, p, np.concatenate(texts), np.append(0, np.cumsum(sizes - 1)))
    assert set(asked) == {lm_scoring.CONTEXT, lm_scoring.STRIDE}
    # A score is that of the text alone, to the last digit.
    alone = [lm_scoring._text_scores(model, p, t, np.array([0, len(t)]))[0] for t in texts]
    assert together.tolist() == alone


def test_encoder_knows_words_of_earlier_texts():
    encoder = lm_scoring.Tokenizer.load().encoder()
    for texts in (["b a b", "", "c A"], ["zz a", "b  new\nb"], ["", "c zz c"], [""]):
        data = [t.encode() for t in texts]
        offsets = np.append(0, np.cumsum([len(x) for x in data]))
        ids, bounds = encoder.ids(np.frombuffer(b"".join(data), np.uint8), offsets)
        for t, i, j in zip(texts, bounds[:-1], bounds[1:]):
            plain = [encoder._encoding.encode_ordinary(" " + w) for w in t.lower().split()]
            assert ids[i:j].tolist() == sum(plain, [])


def test_gradient_by_differences():
    rng = np.random.default_rng(8)
    shape = (3, lm_scoring.CONTEXT)
    inputs, target = rng.integers(0, 50, shape), rng.integers(0, lm_scoring.CLASSES, shape)
    before, wanted = rng.integers(0, lm_scoring.BUCKETS, shape), rng.random(shape) < 0.7
    prior = np.log(rng.dirichlet(np.ones(lm_scoring.CLASSES), lm_scoring.BUCKETS))
    flat = lm_scoring.initial().astype(np.float64)

    def loss(at):
        p = lm_scoring._unpacked(at)
        return -lm_scoring.log_probabilities(p, inputs, prior, before, target, wanted).mean() * math.log(10)

    got = lm_scoring._gradient(lm_scoring._unpacked(flat), inputs, prior, before, target, wanted)
    for i in [*np.argsort(-np.abs(got))[:20], *rng.integers(0, len(flat), 20)]:
        step = np.zeros_like(flat)
        step[i] = 1e-4
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-4, rel=1e-2, abs=1e-5)


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>a<p>b", "a\n\nb"), ("a<br>b <b> c</b>", "a\nb c"),
    ("<ul><li>a<li>b<ol><li>x<li>y</ol></ul>", "- a\n- b\n  1. x\n  2. y"),
    ("<table><tr><td>1<td>long<tr><th>22<td>z</table>", "1   long\n22  z"),
    ("<p hidden>no<script>x</script><div style='display: none'>no<p>no</div>yes", "yes"),
    ("<pre>a\n  b</pre>", "a\n  b"), ("</div>&amp; <p>x</table>y", "&\n\nxy"),
])
def test_rendering(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><p>text<div>more", "text\n\nmore"), ("<head><title>T</title>text <b>more</b>", "text more"),
    ("<head>\n<meta charset=x><link rel=y><script>s</script><noscript>n</noscript>\n<title>T</title></head><body>b", "b"),
    ("a <i aria-hidden='true'>b</i> c", "a b c"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
    ("a<math><mi>x</mi><annotation>tex</annotation></math>", "ax"),
    ("<div style='visibility: hidden'>no<b style='visibility:visible'>yes<i>too</i></b>no</div>", "yestoo"),
    ("<ol style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ol>", "2. yes"),
    ("<div style='visibility:hidden'><hr><table><tr><td>no</table></div>yes", "yes"),
    ("<p>a<svg width='3'/>b <math/>c<p>d", "ab c\n\nd"), ("<p>a<svg><path d='x'/><g>no</g></svg>b", "ab"),
    ("a<b/>c<div/>d", "ac\nd"),
])
def test_rendering_of_implied_and_foreign_tags(html, text):
    assert html_render.render(html) == text


def test_deep_and_wide_pages_end():
    assert html_render.render("<div>" * 20_000 + "x") == "x"
    assert html_render.render("<ul><li>" * 3000 + "x").strip("- ") == "x"


def test_empty_tables(docs, items):
    none = docs.limit(0)
    assert ngram_join.one_per_class(none).isEmpty() and suffix_dedup.without_repeats(none).isEmpty()
    assert decontaminate.contamination(none, items).isEmpty() and licenses.scan(none).isEmpty()
    assert decontaminate.contamination(docs, items.limit(0)).filter("n_hit > 0").isEmpty()
    assert quality_rules.keep_good(none).isEmpty() and lm_scoring.base_scores(none, F.lit(False)).isEmpty()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark):
    source, database = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{source}/{table}.parquet'")
    expected = database.execute(ORACLE_SQL[name])
    columns = [d[0] for d in expected.description]
    got = QUERIES[name](spark, source)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_pipeline(spark, docs, items, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        current.sparkSession.catalog.clearCache()
        out = stage(spark, current, str(tmp_path))
        path = f"{tmp_path}/stage-{name}"
        out.write.parquet(path)
        current = spark.read.parquet(path)
        left.append(sorted(r.doc_id or 0 for r in current.collect()))
        if name != "mixture_weights":
            assert current.columns == docs.columns
    assert left[:4] == [[0, 1, 2, 3, 4, 5, 11, 13], [0, 1, 4, 5, 11, 13], [0, 1, 4, 5, 11, 13], [0, 1, 5, 11, 13]]
    assert set(left[4]) <= set(left[3])
    assert len(corpus_pipeline.STAGES) == 5
