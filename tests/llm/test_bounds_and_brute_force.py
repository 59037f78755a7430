"""Bounds of page rendering, and the classifier, the mixture, the scores and the rules against plain Python."""

from __future__ import annotations

import re
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import html_render, lm_scoring, mixing, quality_classifier, quality_rules, suffix_dedup

DEEP = "<div>" * 3000


@pytest.mark.parametrize("html, size", [
    (f"<table><tr><td>{DEEP}a</td><td>{DEEP}b</td></tr></table>", 10),
    ("<div>x" * 10_000, 40_000),
    ("<p><table><tr><td>" + "<div>x" * 10_000, 40_000),
    ("<table><tr><td>" + "y" * 20_000 + "</td><td>z</td></tr>" + "<tr><td>a</td><td>b</td></tr>" * 500 + "</table>", 30_000),
    ("<ul><li>a" * 3000, 400_000),
    ("<table><tr><td>a</td><td>" * 3000, 500_000),
    ("<li><div>" * 10_000 + "</b>" * 10_000, 1),
])
def test_deep_and_wide_pages_end_soon_and_stay_small(html, size):
    started = time.process_time()
    text = html_render.render(html)
    assert time.process_time() - started < 10 and len(text) <= size
    # No letter of the page is lost.
    for letter in "abxyz":
        visible = sum(part.split(">")[-1].count(letter) for part in html.split("<"))
        assert text.count(letter) == visible


def test_end_tags_close_what_they_did_before():
    cases = {
        "<p>a<div>b</p>c": "a\n\nbc", "<table><tr><td>a</div>b</td></tr></table>": "ab",
        "<ul><li>a<p>b<li>c</ul>d": "- a\n\n  b\n- c\n\nd", "<b>a<table><tr><td>c</b>d</table>e": "a\n\ncd\n\ne",
        "<dl><dt>a<dd>b<dt>c</dl>": "a\nb\nc", "<select><option>a<option>b</select>": "a\nb",
    }
    assert {html: html_render.render(html) for html in cases} == cases


def test_pages_of_awkward_tables(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (None, None), (2, "")]
    table = spark.createDataFrame([(*r, "t", 7) for r in rows], "page_id long, html string, text string, n_lines long")
    got = sorted(map(tuple, html_render.rendered(table).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (1, "a", 1), (None, "", 0), (2, "", 0)], key=repr)
    assert html_render.rendered(table.limit(0)).count() == 0


def prose(seed: int, n: int, mark: str = "") -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}{mark}" for i in rng.integers(0, 300, n))


def test_compressed_sizes_text_by_text(spark):
    rows = [(i, prose(i, 50 + 40 * (i % 30), "##" if i % 2 else ""), i % 2) for i in range(80)]
    rows += [(90, None, 1), (91, "", 0), (92, "é" * 5000, 1), (92, "é" * 5000, 1), (None, "x", 1)]
    table = spark.createDataFrame([(*r, 1.0, b"") for r in rows],
                                  "doc_id long, text string, quality int, score double, bytes binary")
    model = quality_classifier.fit(table, table.select("doc_id", "quality"))
    got = quality_classifier.score(table, model).collect()
    coders = [zstandard.ZstdCompressor(level=quality_classifier.LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                       write_content_size=False, write_checksum=False, write_dict_id=False)
              for d in (model.bad, model.good)]
    piece = quality_classifier.PIECE
    for (doc, text, *_), row in zip(rows, got):
        data = (text or "").encode()
        sizes = [sum(len(c.compress(data[a : a + piece])) for a in range(0, len(data), piece)) for c in coders]
        difference = (sizes[0] - sizes[1]) / len(data) if data else 0.0
        assert row["doc_id"] == doc and row["difference"] == pytest.approx(difference, abs=1e-12)
        logit = min(max(model.slope * difference + model.intercept, -30), 30)
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-logit)))
    none = quality_classifier.fit(table.limit(0), table.limit(0))
    assert quality_classifier.score(table.limit(0), none).count() == 0


def test_an_id_of_very_many_rows_fills_no_sample(spark):
    many = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("same "), F.col("id").cast("string")).alias("text"))
    others = spark.createDataFrame([(i, prose(i, 200, "!" if i % 2 else "")) for i in range(2, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    model = quality_classifier.fit(many.unionByName(others), labels, pieces=50, texts=40)
    scored = quality_classifier.score(others, model).collect()
    right = np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in scored])
    assert right > 0.9


def test_raking_in_plain_python(spark):
    rng = np.random.default_rng(2)
    rows = [(a, b, c, int(rng.integers(1, 500))) for a in "abc" for b in "xyz" for c in "pq" if rng.random() < 0.8]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, __tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.2, "y": 0.2, "z": 0.6}, "topic": {"p": 0.4, "q": 0.6}}
    frames = {n: spark.createDataFrame(list(t.items()), "value string, share double") for n, t in targets.items()}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in mixing.rake(cells, frames).collect()}
    weight = {r[:3]: float(r[3]) for r in rows}
    for _ in range(200):
        for place, name in enumerate(("source", "lang", "topic")):
            sums: dict = {}
            for key, w in weight.items():
                sums[key[place]] = sums.get(key[place], 0.0) + w
            weight = {key: w * targets[name][key[place]] / sums[key[place]] for key, w in weight.items()}
    assert got.keys() == weight.keys()
    assert all(got[k] == pytest.approx(weight[k], abs=1e-7) for k in weight)


def test_mixture_of_awkward_rows(spark):
    rows = [(i, prose(i, 30), "s", "en") for i in range(40)]
    rows += [(None, prose(1, 30), None, None), (3, prose(3, 30), "s", "en"), (70, None, "s", "en"), (71, "", "t", "de")]
    table = spark.createDataFrame([(*r, "mine", 0.5, 3) for r in rows],
                                  "doc_id long, text string, source string, lang string, topic string, probability double, copies int")
    out = mixing.mixed_sample(table, budget_share=1.0)
    got = out.collect()
    # Everything with tokens in its cell is drawn at a budget of all tokens; equal rows share their fate.
    assert sorted(set(out.columns)) == sorted(set(table.columns))
    ids = [r["doc_id"] for r in got]
    assert ids.count(3) == 2 and 71 not in ids and all(r["topic"] == "prose" for r in got)


def test_equal_texts_score_alike_wherever_they_stand(spark):
    texts = ["", None, " \n", "one two three", prose(5, 400), prose(6, 40)]
    rows = [(i, texts[i % len(texts)]) for i in range(60)] + [(100 + i, prose(i, 10 + i)) for i in range(40)]
    table = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    model = lm_scoring.fit(table)
    found = [
        {r["doc_id"]: r["score"] for r in lm_scoring.score(table.repartition(n), model).collect()} for n in (1, 7)
    ]
    assert found[0] == found[1]
    for k in range(len(texts)):
        assert len({found[0][i] for i in range(k, 60, len(texts))}) == 1
    assert found[0][0] == found[0][1] == found[0][2]
    # Nothing to learn from, and nothing to score.
    empty = lm_scoring.fit(table.limit(0))
    assert np.isfinite([r["score"] for r in lm_scoring.score(table, empty).collect()]).all()
    assert lm_scoring.score(table.limit(0), model).count() == 0


def test_the_only_rule_that_rejects(spark):
    schema = "doc_id long, text string"
    rows = [(1, "short"), (2, "same words here " * 40), (3, prose(1, 100)), (4, None), (5, prose(2, 100) + " ####" * 30)]
    table = spark.createDataFrame(rows, schema)
    judged = quality_rules.apply_policy(quality_rules.ledger(table), "v3").withColumn("only", quality_rules.only_rule("v3"))
    for r in judged.collect():
        failed = [rule.name for i, rule in enumerate(quality_rules.RULES) if r["fail_bits"] >> i & 1]
        assert r["only"] == (failed[0] if len(failed) == 1 else None)
    counted = {(r["policy"], r["rule"]): r["n_only"] for r in quality_rules.ablation(judged).collect()}
    own = [r["only"] for r in judged.collect()]
    assert all(counted.get(("v3", rule.name), 0) == own.count(rule.name) for rule in quality_rules.RULES)


def test_remaining_texts_belong_to_their_digests(spark):
    import hashlib

    passage = prose(9, 150)
    table = spark.createDataFrame(
        [(1, prose(1, 60) + " " + passage), (2, passage + " " + prose(2, 60)), (3, prose(3, 60)), (4, None)], "doc_id long, text string"
    )
    out = suffix_dedup.without_repeats(table, keep_first=False).collect()
    for r in out:
        assert hashlib.sha256((r["text"] or "").encode()).hexdigest() == r["dedup_sha256"]
    assert sum(r["dedup_removed"] > 0 for r in out) == 2


def test_texts_are_encoded_once_for_training_and_scoring(spark, tmp_path):
    rows = [(i, prose(i, 20 + i) if i % 9 else None) for i in range(60)] + [(None, "no id"), (7, prose(7, 27))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") % 10 == 0
    texts = lm_scoring.encode(table, held)
    assert {r["held_out"] for r in texts.collect()} == {True, False}
    calls = spark.sparkContext.accumulator(0)

    class Counted(lm_scoring.Tokenizer):
        def encoder(self):
            own = super().encoder()
            count, ids = calls, own.ids
            own.ids = lambda data, offsets: count.add(len(offsets) - 1) or ids(data, offsets)
            return own

    tokenizer = Counted(lm_scoring.Tokenizer.load().content)
    path = str(tmp_path / "ids")
    lm_scoring.encode(table, held, tokenizer=tokenizer).write.parquet(path)
    stored = spark.read.parquet(path)
    model = lm_scoring.fit_encoded(stored.filter(~F.col("held_out")), tokenizer)
    got = sorted(map(tuple, lm_scoring.score_encoded(stored, model).collect()), key=repr)
    assert calls.value == len(rows)
    # The scores of a model are those it gives to texts that are encoded for scoring alone.
    assert got == sorted(map(tuple, lm_scoring.score(table, model).collect()), key=repr) and len(got) == len(rows)
    # What is held out has no part in the counts.
    known = lm_scoring.fit(table.filter(~F.coalesce(held, F.lit(True))), rounds=0)
    np.testing.assert_array_equal(known.neighbours.share, model.neighbours.share)


def test_words_met_before_are_not_encoded_again(monkeypatch):
    tokenizer, texts = lm_scoring.Tokenizer.load(), [prose(i, 50).encode() for i in range(6)]

    def ids(encoder, text):
        return encoder.ids(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tolist()

    kept, expected = tokenizer.encoder(), [ids(tokenizer.encoder(), t) for t in texts]
    asked = []
    plain = kept._learn
    monkeypatch.setattr(kept, "_learn", lambda marks, *rest: asked.append(len(marks)) or plain(marks, *rest))
    assert [ids(kept, t) for t in texts * 2] == expected * 2
    assert len(asked) <= len(texts) and sum(asked) == len({w for t in texts for w in t.lower().split()})
    # Starting anew changes nothing.
    monkeypatch.setattr(lm_scoring, "_KNOWN", 10)
    assert [ids(kept, t) for t in texts] == expected


def test_vocabulary_is_read_once_in_a_process():
    content = lm_scoring.Tokenizer.load().content
    text = np.frombuffer(prose(3, 200).encode(), np.uint8)
    first, second = (lm_scoring.Tokenizer(bytes(bytearray(content))).encoder() for _ in range(2))
    expected = first.ids(text, np.array([0, len(text)]))[0].tolist()
    assert first._encoding is second._encoding
    # Words are remembered by each encoder for itself, in 16 bytes and 4 for each id.
    assert not len(second._known) and second.ids(text, np.array([0, len(text)]))[0].tolist() == expected
    assert first._starts.itemsize + first._sizes.itemsize == 8 and first._flat.itemsize == 4


def test_topics_look_at_each_place_once(spark):
    slow = (
        ("legal", "(?i)licen[sc]e"), ("contact", "[a-z0-9.]+@[a-z0-9.]+|[0-9]{3}-[0-9]{4}"), ("table", " [|] "),
    )
    texts = [
        None, "", "prose", "a@b", "@b", "a@", "A@b", "a@B", "x@.", "é@é", "@@a@@", "12-3456", "123-4567", "0123-45678",
        "123-456", "a | b", "a|b", " | ", "| ", "my LiCeNcE a@b", "licenze", "a | b x@y", "555-1234 | licence", "- 123-4567",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for i, topic in rows.select("i", mixing.topic_of(F.col("text"))).collect():
        expected = next((n for n, p in slow if texts[i] and re.search(p, texts[i])), "prose")
        assert topic == expected, texts[i]
    # One word without a sign of a topic: its length squared took minutes.
    long = spark.range(1).select(F.repeat(F.lit("a"), 200_000).alias("text"))
    started = time.monotonic()
    assert long.select(mixing.topic_of(F.col("text"))).first()[0] == "prose"
    assert time.monotonic() - started < 20
