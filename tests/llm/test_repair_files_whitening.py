"""Conversation repair, token files and whitening against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import conversation_repair as repair
from tidemark.llm import token_files, whitening
from tidemark.llm.elias_fano import EliasFano
from tidemark.sources.storage import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SPACE = " \t\n\x0b\x0c\r"


# --- conversation repair -------------------------------------------------------------


def plain_repair(rows: list[tuple[str, str, str | None]]) -> tuple[int, str]:
    """Cheapest cost and ASCII-least letters of (initial, _, fault) rows, by a search over (cost, letters)."""
    queue, best = [(0, "", 0, "")], {}
    while queue:
        cost, audit, i, shape = heapq.heappop(queue)
        # ``shape`` is the last initial, or nothing yet.
        if i == len(rows) and shape in ("", "a"):
            return cost, audit
        if best.setdefault((i, shape, len(audit)), (cost, audit)) != (cost, audit):
            continue
        due = {"": "u", "s": "u", "u": "a", "a": "u"}[shape]
        if len(audit) < 3 * len(rows) + 3:
            heapq.heappush(queue, (cost + 5, audit + "I", i, due))
        if i < len(rows):
            initial, _, fault = rows[i]
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, shape))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                heapq.heappush(queue, (cost + more + 1, audit + "R", i + 1, due))
                if initial == due or (initial == "s" and shape == ""):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, initial))
    raise AssertionError


def plain_report(rows: list[tuple]) -> dict:
    """All figures of one conversation's (turn, role, text) rows after damage, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        rest = text.rstrip(SPACE)
        faults.append(
            "blank" if not rest else "duplicate" if (role, text) in seen
            else "truncated" if rest[-1] not in ".!?" else None
        )
        seen.add((role, text))
    cost, audit = plain_repair([(role[:1], text, f) for (_, role, text), f in zip(rows, faults)])
    at, out = 0, []
    for letter in audit:
        due = "user" if not out or out[-1][0][:1] != "u" else "assistant"
        if letter == "I":
            out.append((due, ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            out.append((due if letter == "R" else role, text))
    initials = [role[:1] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def plain_damage(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        elif fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate != 0:
            mine.extend([(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1))
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def conversations(count: int, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(count)]:
        for turn in range(rng.randint(1, 7)):
            rows.append((
                conv, None if rng.random() < 0.1 else turn * rng.choice((1, 1, 2)),
                rng.choice(("user", "assistant", "system", "user", "assistant", "tool", "", "umpire", None)),
                rng.choice(("One.", "Two!", "three", "four ", "Five?\n", "", " \t", "é.", None, "One.")),
            ))
    rows += rows[:9]
    return rows


def test_conversations_by_brute_force(spark):
    rows = conversations(250)
    # Columns of the names the operator uses itself go, whatever they hold.
    table = spark.createDataFrame(
        [(*r, "x", 1, None) for r in rows],
        "conv_id long, turn long, role string, text string, conv string, first int, copies string",
    )
    got = {r["conv"]: r.asDict() for r in repair.reports(repair.damaged(table)).collect()}
    expected = plain_damage(rows)
    assert got.keys() == expected.keys()
    for conv, mine in expected.items():
        want = plain_report(mine)
        assert {k: got[conv][k] for k in want} == want, conv
        assert got[conv]["n_rows"] == len(mine)


def test_conversations_equal_sql(spark):
    table = spark.createDataFrame(conversations(60, 2), "conv_id long, turn long, role string, text string")
    pandas = table.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    database = duckdb.connect()
    database.register("given", pandas)
    database.execute("CREATE TABLE conversations AS SELECT * FROM given")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = database.execute(f"SELECT {', '.join(names)} FROM ({repair.ORACLE})").fetchall()
    got = repair.reports(repair.damaged(table)).withColumnRenamed("conv", "conv_id").select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


@given(st.lists(st.integers(0, 11), max_size=7), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_cheapest_edits(codes, block):
    rows = [("sua?"[c % 4], "", (None, "truncated", "blank")[c // 4]) for c in codes]
    assert repair.cheapest(bytes(codes)) == plain_repair(rows)
    # Joined from blocks, as very long conversations are.
    assert repair.cheapest(bytes(codes), block) == plain_repair(rows)


def test_long_conversations_take_blocks():
    codes = bytes(random.Random(3).choices(range(12), k=3000))
    assert repair.cheapest(codes, 100) == repair.cheapest(codes, 4096)


def test_repaired_rows_and_texts_beyond_memory(spark, monkeypatch):
    long_text = "word " * 100_000 + "end."
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", long_text), (1, 2, "assistant", "Yes."), (1, 3, "assistant", "cut"),
        (2, 0, "assistant", "Hello."), (2, 1, "user", "Bye."), (3, 5, "tool", ""),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = repair.repaired(repair.undamaged(table)).orderBy("conv", "place").collect()
    assert [(r["conv"], r["edit"], r["role"], r["text"]) for r in out] == [
        (1, "K", "system", "Be kind."), (1, "K", "user", long_text), (1, "K", "assistant", "Yes."),
        (2, "R", "user", "Hello."), (2, "R", "assistant", "Bye."),
    ]
    monkeypatch.setattr(repair, "_MEMORY_BYTES", 100)
    reports = repair.reports(repair.undamaged(table)).orderBy("conv").collect()
    assert [r["audit"] for r in reports] == ["KKKD", "RR", "D"]
    assert repair.reports(repair.damaged(table.limit(0))).count() == 0


# --- token files ---------------------------------------------------------------------


@given(st.lists(st.integers(0, 2**64 - 1), max_size=600), st.integers(0, 63))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, shift):
    values = np.sort(np.array([v >> shift for v in values], np.uint64))
    made = EliasFano.of(values)
    data = b"xyz" + made.to_bytes() + b"rest"
    read, end = EliasFano.from_buffer(memoryview(data), 3)
    assert data[end:] == b"rest"
    ranks = np.random.default_rng(1).permutation(len(values))
    assert (read.select(ranks) == values[ranks]).all()


def test_elias_fano_is_small_and_checks():
    values = np.sort(np.random.default_rng(1).integers(0, 10**7, 20_000))
    # log2(u / n) low bits, two high ones, and samples.
    assert len(EliasFano.of(values).to_bytes()) * 8 < 20_000 * 11.5
    with pytest.raises(ValueError):
        EliasFano.of(np.array([2, 1]))
    with pytest.raises(IndexError):
        EliasFano.of(np.array([1, 2])).select([2])


@pytest.fixture(scope="module")
def vocabulary():
    return token_files.load_vocabulary(TOKENIZER, 2)


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return made


PIECES = ["a", "b7", "é", " ", "  ", "\n", "\t", "_", "'s", "<|endoftext|>", "日本", " ", ",", "the", " the", "\x1f",
          " ", "x y", "\r\n "]


@given(st.lists(st.sampled_from(PIECES), max_size=40), st.integers(1, 50))
@settings(max_examples=400, deadline=None)
def test_pieces_encode_like_whole_texts(pieces, slice_size):
    text = "".join(pieces)
    encoder = test_pieces_encode_like_whole_texts.encoder = getattr(
        test_pieces_encode_like_whole_texts, "encoder", None
    ) or token_files.Encoder(token_files.load_vocabulary(TOKENIZER, 2))
    before, token_files._SLICE = token_files._SLICE, slice_size
    try:
        got = np.frombuffer(b"".join(encoder.encode(text)), "<u2").tolist()
    finally:
        token_files._SLICE = before
    assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_by_brute_force(spark, vocabulary, tokenizer):
    rng = random.Random(5)
    texts = ["", None, " ", "one two", "one two", "word " * 30_000, "no" * 5000, "line\nline\n\n  end ", "<|endoftext|> 2"]
    rows = [(i - 40, rng.choice(texts) if i % 3 else f"text {i} of {rng.random()}") for i in range(120)]
    rows += [(7, "seven again"), (7, "seven again"), (None, "no id"), (2**62, "far"), (-(2**62), "first")]
    rng.shuffle(rows)
    table = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows], "doc_id long, text string, part string, start long, n_tokens int"
    ).repartition(5)
    path = scratch_path(spark, "token-test")
    token_files.write(table, path, vocabulary, file_tokens=5000)
    found = token_files.read(spark, path, ids=True)
    # Several files in a partition, and several partitions.
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files) > 5
    got = token_files.offsets(found).orderBy("start").collect()
    expected = sorted(
        (i is not None, i or 0, [*(tokenizer.encode(t or "", add_special_tokens=False).ids), 2]) for i, t in rows
    )
    assert sorted((r["doc"] is not None, r["doc"] or 0, r["ids"]) for r in got) == expected
    assert [r["doc"] for r in got] == sorted((r["doc"] for r in got), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]


def test_token_files_without_documents(spark, vocabulary):
    path = scratch_path(spark, "token-test")
    token_files.write(spark.createDataFrame([], "doc_id long, text string"), path, vocabulary)
    assert token_files.offsets(token_files.read(spark, path)).collect() == []


def test_one_file_round_trip():
    ids = np.arange(70_000, 70_010, dtype="<u4")
    content = token_files.file_of(ids.tobytes(), 4, [4, 1, 5], [None, 3, 3], 7, 2, 100) + b"\n"
    read = token_files.TokenFile(content)
    assert (read.part, read.file, read.start, read.document_ids()) == (7, 2, 100, [None, 3, 3])
    assert [read.document(k).tolist() for k in range(3)] == [list(range(70_000, 70_004)), [70_004], list(range(70_005, 70_010))]
    with pytest.raises(ValueError):
        token_files.TokenFile(content[:-5])


def test_other_tokenizers_encode_whole_texts():
    words = token_files.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"), 2)
    assert not words.in_pieces
    encoder = token_files.Encoder(words)
    text = "Some words, and  more.\nEnd"
    assert np.frombuffer(b"".join(encoder.encode(text)), "<u2").tolist() == encoder.tokenizer.encode(
        text, add_special_tokens=False
    ).ids


# --- whitening -----------------------------------------------------------------------


@given(
    st.integers(1, 130), st.integers(1, 5), st.sampled_from([1, 8, 1000, 2**40, 2**62]), st.integers(0, 1000),
)
@settings(max_examples=60, deadline=None)
def test_scatter_is_exact(n, dims, size, seed):
    x = np.random.default_rng(seed).integers(-size, size, (n, dims), endpoint=True)
    ones = np.column_stack([x.astype(object), np.ones(n, object)])
    expected = ones.T.dot(ones)
    got = whitening.scatter(x)
    assert all(got[i][j] == expected[i, j] for i in range(dims + 1) for j in range(i, dims + 1))


def test_entries_beyond_longs():
    x = whitening.integers(np.array([[1e300, -1e300, 0.01, -0.01, 2.0**57, -(2.0**57)]]))[0].tolist()
    top = 2**63 - 1 - whitening.OFFSET
    assert x == [top, -(2**63), 0, -1, top, -(2**63)]


def vectors(n: int, dims: int, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return (rng.normal(0, 0.3, (n, dims)) @ rng.normal(0, 1, (dims, dims))).astype(np.float32)


def test_whitening_by_brute_force(spark):
    data = vectors(300, 40)
    data[:, 5] = 0.25
    data[:20] = data[20]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    bad = [
        (1000, None), (1001, [None, *[0.0] * 39]), (1002, [float("nan")] * 40), (1003, [float("inf"), *[0.0] * 39]), (1004, []),
    ]
    table = spark.createDataFrame(
        [(*r, 1, "x", 2.0) for r in rows + bad], "vec_id long, embedding array<float>, component int, id string, n double"
    ).repartition(4)
    fits = whitening.fit(table)
    got = whitening.whitened(table, fits).toPandas()
    assert set(got["vec_id"]) == {r[0] for r in rows} and len(got) == 300 * 32
    x = np.floor(64 * data.astype(float)).astype(np.int64) + whitening.OFFSET
    n, sums = len(x), x.sum(axis=0)
    exact = ((n * x - sums) ** 2).sum(axis=1)
    covariance = np.cov(x.T.astype(float), bias=True)
    values = np.linalg.eigvalsh(covariance)[::-1]
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert (got["n"] == n).all()
    assert (got.groupby("vec_id")["deviation"].first().map(int).to_numpy() == exact).all()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(32)).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    shares = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(shares, (values / values.sum())[:32], rtol=1e-9)
    # Each component is an eigenvector: the covariance of x with it is the eigenvalue's root times it.
    centred = x - sums / n
    axes = centred.T @ wide / n
    for k in range(32):
        axis = axes[:, k] / np.linalg.norm(axes[:, k])
        assert np.allclose(covariance @ axis, values[k] * axis, atol=1e-6 * values[0])
        assert np.allclose(centred @ axis / np.sqrt(values[k]), wide[:, k], atol=1e-8)
    again = whitening.fit(table.repartition(2))
    assert (again[40].vectors == fits[40].vectors).all() and again[40].sums == fits[40].sums


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([(1, None)], schema)
    assert whitening.whitened(none, whitening.fit(none)).count() == 0
    assert whitening.fit(none.limit(0)) == {}
    # One vector, and vectors of two lengths, each a list of its own; an id that repeats and one that is NULL.
    some = spark.createDataFrame([(1, [0.5, 1.0]), (None, [0.0]), (2, [1.0]), (2, [1.0])], schema)
    got = whitening.whitened(some, whitening.fit(some)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [
        (0, 1, 3), (1, 1, 1), (1, 2, 1), (2, 1, 3), (2, 1, 3),
    ]
    assert {r["whitened"] for r in got if r["vec_id"] == 1} == {0.0}
    far = spark.createDataFrame([(1, [3e38]), (2, [-3e38]), (3, [0.0])], schema)
    rows = whitening.whitened(far, whitening.fit(far)).select("whitened", F.col("deviation").try_cast("long")).collect()
    assert len(rows) == 3 and all(abs(r[0]) < 2 for r in rows) and rows[0][1] is None
