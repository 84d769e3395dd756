"""Resampling, SentencePiece and vector codes, each against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hard_rows import empty, hard, multiset, texts  # noqa: F401
from veloclima.llm import resampling, sentence_pieces, vector_codes
from veloclima.llm._tables import Written
from veloclima.llm.oracle import ORACLES

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def same_as_sql(name, tables, rows):
    con = duckdb.connect()
    for table, df in tables.items():
        con.register(table, df.toArrow())
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert multiset(map(tuple, rows.select(*columns).collect())) == multiset(result.fetchall())


# --- resampling ----------------------------------------------------------------------------


def grams_of(t, orders=2):
    w = NORMAL.findall(low(t))
    return w, [" ".join(w[k : k + n]) for n in range(1, orders + 1) for k in range(len(w) - n + 1)]


def resampled_by_hand(rows, target, percent, least, seed=7, orders=2, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in rows for g in grams_of(t, orders)[1])
    t_ = Counter(bucket(g) for t in target for g in grams_of(t, orders)[1])
    above, below = sum(s.values()) + buckets, sum(t_.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t_[b] + 1) * above / ((s[b] + 1) * below)))
    out = []
    for i, t in rows:
        w, grams = grams_of(t, orders)
        weight = sum(gain(bucket(g)) for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[: len(order) * percent // 100]):
        r[5] = k + 1
    return out


@pytest.mark.parametrize(("orders", "buckets", "percent"), [(2, 10_000, 25), (3, 64, 60)])
def test_resampling_by_hand(spark, hard, empty, texts, orders, buckets, percent):
    target = [t for _, t in texts if t and len(t) < 300][:8] + [None, ""]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    rows = resampling.resample(hard, bench, percent, 20, orders=orders, buckets=buckets)
    assert "text" not in rows.columns and "size" in rows.columns and rows.columns.count("n_words") == 1
    got = [(r.doc_id, *(r[c] for c in resampling.RESULT)) for r in rows.collect()]
    want = [tuple(r) for r in resampled_by_hand(texts, target, percent, 20, orders=orders, buckets=buckets)]
    # rows that repeat an id tie, and either may come first
    assert multiset(r[:5] for r in got) == multiset(r[:5] for r in want)
    assert multiset((r[4], r[5]) for r in got) == multiset((r[4], r[5]) for r in want)
    assert multiset(r for r in got if r[0] != 22 and r[0] is not None) == multiset(r for r in want if r[0] != 22 and r[0] is not None)
    assert resampling.resample(empty, bench).count() == 0
    clash = {f"_{name}": F.lit(name) for name in ("row", "part", "place", "before", "found", "noise")}
    beside = resampling.resample(hard.withColumns(clash), bench, percent, 20, orders=orders, buckets=buckets)
    assert {r._before for r in beside.collect()} == {"before"} and set(clash) < set(beside.columns)
    none = resampling.resample(hard, bench.limit(0), keep_text=True)
    assert none.count() == len(texts) and "text" in none.columns


def test_resampling_is_its_sql(spark, hard, texts):
    rows = [(k, t, "x") for k, (_, t) in enumerate(texts) if t is None or len(t) < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bench = spark.createDataFrame([(1, texts[20][1]), (2, None)], "item_id long, text string")
    got = resampling.resample(docs, bench)
    same_as_sql("op11_resampling", {"documents": docs, "benchmark": bench}, got)


def test_the_draw_leans_to_the_target(spark):
    rng = random.Random(5)
    word = lambda kind: kind + rng.choice("abcdefghij")
    rows = [(k, " ".join(word("x" if k % 5 == 0 else "y") for _ in range(40))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(k, " ".join(word("x") for _ in range(40))) for k in range(20)], "item_id long, text string")
    drawn = resampling.resample(docs, target).where("rank is not null")
    ranks = sorted(r["rank"] for r in drawn.collect())
    assert ranks == list(range(1, 101))
    assert drawn.where("doc_id % 5 = 0").count() > 70  # 80 of 400, a fifth without any lean


def test_interned_grams_share_slots_only_when_bytes_agree(monkeypatch):
    texts_ = [" ".join(["a", "b" * 31, "b" * 32, "b" * 33, "é" * 40 + "x", "é" * 40 + "y"] * 3).encode(), b"", b"a b\0c"]
    grams = resampling.Grams(texts_, 2)
    values = [bytes(grams.data[s : s + n]) for s, n in zip(grams.start, grams.length)]
    table = resampling.Interned(grams.data, grams.start, grams.length, 997)
    assert [int(k) for k in table.keys] == [xxhash.xxh64_intdigest(v) for v in values]
    slots = dict(zip(values, table.slot.tolist()))
    assert [slots[v] for v in values] == table.slot.tolist() and len(set(slots.values())) == len(set(values))
    assert all(table.count[slots[v]] == n and table.bucket[slots[v]] == zlib.crc32(v) % 997 for v, n in Counter(values).items())
    # all keys alike: bytes alone tell n-grams apart
    monkeypatch.setattr(resampling.Interned, "hashes", lambda self: np.zeros(len(self.start), np.uint64))
    clash = resampling.Interned(grams.data, grams.start, grams.length, 997)
    again = dict(zip(values, clash.slot.tolist()))
    assert [again[v] for v in values] == clash.slot.tolist() and len(set(again.values())) == len(set(values))


def test_long_texts_are_interned_in_slices(monkeypatch):
    text = " ".join(random.Random(1).choice(["aa", "b", "ccc", "d"]) for _ in range(5000)).encode()
    want = Counter(zlib.crc32(g.encode()) % 97 for g in grams_of(text.decode())[1])
    monkeypatch.setattr(resampling, "SLICE", 700)
    total = np.zeros(97, np.int64)
    for _, _, grams in resampling._grams([b"", text, b"x"], 2):
        for start, length, _ in grams.slices():
            table = resampling.Interned(grams.data, start, length, 97)
            np.add.at(total, table.bucket, table.count)
    want[zlib.crc32(b"x") % 97] += 1
    assert {k: int(n) for k, n in enumerate(total) if n} == dict(want)


def test_ranks_over_many_partitions_with_one_hot_id(spark, conf):
    conf("spark.sql.shuffle.partitions", "7")
    rows = [(1 if k % 3 == 0 else k, 30, 5, k % 4, k % 4) for k in range(600)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long").repartition(5)
    ranked = resampling.draw(scored, Written(spark, "test"), percent=50)
    got = sorted((r["rank"], -r.score, r.doc_id) for r in ranked.where("rank is not null").collect())
    assert [r[0] for r in got] == list(range(1, 301))
    assert [r[1:] for r in got] == sorted((-r[4], r[0]) for r in rows)[:300]


# --- SentencePiece -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    tokenizers = pytest.importorskip("public_tokenizers")
    return sentence_pieces.read_model(tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "a▁ b", "\0", "a\nb\tc", "<s>", "</s> x", "é 😀\U0010ffff", "x" * 3000, " " * 500, "中文 文"]


def test_round_trip_equals_the_library(spark, hard, empty, texts, model, library):
    rows = [(i, t) for i, t in texts] + [(1000 + k, t) for k, t in enumerate(ODD)]
    docs = hard.select("doc_id", "text", "kept").unionByName(
        spark.createDataFrame(rows[len(texts) :], "doc_id long, text string"), allowMissingColumns=True
    )
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)))
    assert sentence_pieces.cuts_at_markers(model)
    both = sentence_pieces.round_trip(docs, model)
    assert both.columns == ["doc_id", "text", "kept", "n_tokens", "ids", "decoded"]
    assert multiset((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in both.collect()) == multiset(want)
    apart = sentence_pieces.decode(sentence_pieces.encode(docs, model), model)
    assert multiset((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in apart.collect()) == multiset(want)
    plain = sentence_pieces.encode(docs, model, begin=False, end=False).withColumn("numbers", sentence_pieces.unpacked("ids"))
    assert multiset((r.doc_id, r.numbers) for r in plain.collect()) == multiset((i, library.encode(t or "")) for i, t in rows)
    assert sentence_pieces.round_trip(empty, model).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids binary")
    assert sentence_pieces.decode(nothing, model).first().decoded is None


def test_chunks_in_any_piece_size_and_a_table_that_starts_afresh(monkeypatch, model, library):
    rng = random.Random(2)
    alphabet = [" ", "  ", "▁", "the", "ing", "é", "\n", "x" * 9, "中", "<", "s", ">"]
    given = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    monkeypatch.setattr(sentence_pieces, "TABLE_CHARS", 500)
    monkeypatch.setattr(sentence_pieces, "GROUP_CHARS", 40)
    table = sentence_pieces.ChunkTable(library)
    assert [x.tolist() for x in sentence_pieces.encode_texts(given, table)] == library.encode(given)
    for text in given:
        pieces = list(sentence_pieces.pieces_of(text, 15))
        assert "".join(pieces) == (" " + text.replace("▁", " ") if text else " ")


def field(number, value):
    """One field of a protocol buffer."""
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 | 2, len(value)]) + value


def test_models_that_cannot_be_cut_go_to_the_library(spark, model, library, monkeypatch):
    trainer, normalizer = field(3, 2), field(1, b"identity") + field(3, 1) + field(4, 0)
    piece = lambda text, kind=1: field(1, field(1, text.encode()) + field(3, kind))
    build = lambda *pieces, t=trainer, n=normalizer: b"".join(pieces) + field(2, t) + field(3, n)
    cuts = sentence_pieces.cuts_at_markers
    assert cuts(build(piece("▁a"), piece("▁▁"), piece("b")))
    assert not cuts(build(piece("a▁b")))  # a piece across a marker
    assert not cuts(build(piece("▁a", 4)))  # defined by a user
    assert not cuts(build(piece("▁a"), t=field(3, 1)))  # unigram
    assert not cuts(build(piece("▁a"), n=normalizer + field(2, b"map")))  # normalises
    assert not cuts(build(piece("▁a"), n=field(3, 1)))  # folds spaces, as models do unless told otherwise
    assert not cuts(build(piece("▁a"), t=trainer + bytes([24 << 3 & 127 | 128, 24 << 3 >> 7, 1])))
    monkeypatch.setattr(sentence_pieces, "cuts_at_markers", lambda _: False)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in sentence_pieces.encode(docs, model).collect()}
    assert got == {k: library.encode(t, add_bos=True, add_eos=True) for k, t in enumerate(ODD)}


def test_a_model_beyond_the_bound_is_refused(tmp_path, monkeypatch):
    (tmp_path / "m").write_bytes(b"x" * 100)
    monkeypatch.setattr(sentence_pieces, "MODEL_BYTES", 99)
    with pytest.raises(ValueError, match="broadcast"):
        sentence_pieces.read_model(str(tmp_path / "m"))


# --- vector codes ----------------------------------------------------------------------------


def coded_by_hand(rows, parts, entries, rounds, scale=1024):
    """(codes, errors, codebooks) by full searches; rows are (id, integers)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    length = len(rows[0][1])
    ends = [k * length // parts for k in range(parts + 1)]
    codes, errors, books = [], np.zeros(len(rows), object), []
    for a, b in zip(ends, ends[1:]):
        x = np.array([r[1][a:b] for r in rows], object)
        book = [list(p) for p in x[:entries]]
        for k in range(rounds + 1):
            far = [[sum((p - q) ** 2 for p, q in zip(row, e)) for e in book] for row in x]
            best = [min(range(len(book)), key=lambda j: (d[j], j)) for d in far]
            for j in set(best) if k < rounds else ():
                own = x[[c == j for c in best]]
                book[j] = [int(sum(col)) // len(own) for col in own.T]
        codes.append(best)
        errors = errors + np.array([d[j] for d, j in zip(far, best)], object)
        books.append(book)
    return [(r[0], bytes(c), int(e)) for r, c, e in zip(rows, zip(*codes), errors)], books


SHAPES = [(8, 4, 16, 4, 1.0), (7, 3, 5, 2, 40.0), (4, 4, 256, 4, 1.0), (2, 4, 3, 3, 1e9)]


@pytest.mark.parametrize(("length", "parts", "entries", "rounds", "spread"), SHAPES)
def test_codes_by_hand(spark, length, parts, entries, rounds, spread):
    rng = np.random.default_rng(length)
    vectors = (rng.standard_normal((90, length)) * spread).tolist() + [[0.5] * length] * 40 + [[-0.25] * length] * 3
    rows = [(k if k % 17 else None, v, f"l{k % 3}" if k % 5 else None, "was code", 1) for k, v in enumerate(vectors)]
    bad = [(500, None, "l0", "x", 1), (501, [], "l0", "x", 1), (502, [1.0] * (length + 1), None, "x", 1)]
    bad += [(503, [float("nan")] * length, "l1", "x", 1), (504, [float("inf")] + [0.0] * (length - 1), "l1", "x", 1)]
    bad += [(505, [None] + [0.0] * (length - 1), "l1", "x", 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label string, code string, other int").repartition(3)
    most = 1 << (60 - (length - 1).bit_length()) // 2
    integers = [(r[0], [max(-most, min(most, math.floor(1024 * x))) for x in r[1]]) for r in rows]
    want, books = coded_by_hand(integers, parts, entries, rounds)
    counted = spark.sparkContext.accumulator(0)
    coded, codebooks = vector_codes.compress(df, parts=parts, entries=entries, rounds=rounds, counted=counted)
    assert coded.columns == ["vec_id", "label", "other", "code", "error", "label_error"]
    got = coded.collect()
    assert multiset((r.vec_id, bytes(r.code), r.error) for r in got) == multiset(want)
    assert [part.tolist() for part in codebooks] == books
    errors = Counter()
    for r in got:
        errors[r.label] += r.error
    assert all(r.label_error == min(errors[r.label], 2**63 - 1) for r in got)
    again = vector_codes.encode(df, codebooks).where("code is not null").collect()
    assert multiset((r.vec_id, bytes(r.code), r.error) for r in again) == multiset(want)
    if spread == 1.0:
        for r in vector_codes.decode(coded, codebooks).limit(5).collect():
            assert len(r.approximation) == length and np.isfinite(r.approximation).all()


def test_codes_are_their_sql(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(16).astype("f4").tolist(), int(k % 4) if k % 7 else None) for k in range(330)]
    rows += [(400, None, 1), (401, [float("nan")] * 16, 1), (402, [None] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    coded, codebooks = vector_codes.compress(df)
    shown = coded.selectExpr("vec_id", "lower(hex(code)) AS code", "error", "label_error", f"'{vector_codes.codebooks_digest(codebooks)}' AS codebooks_sha256")
    same_as_sql("op13_vector_codes", {"embeddings": df}, shown)


def test_no_vectors(spark):
    layout = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 1), (2, [float("inf")], None), (3, [], 2)]):
        coded, codebooks = vector_codes.compress(spark.createDataFrame(rows, layout))
        assert coded.count() == 0 and sum(map(len, codebooks)) == 0
    with pytest.raises(ValueError, match="256"):
        vector_codes.compress(spark.createDataFrame([], layout), entries=257)


def test_bounds_hold_and_spare_searches():
    """Norm-of-sum bounds: every bound is below the true distances of its round, codes equal a full search."""
    rng = np.random.default_rng(8)
    for trial in range(12):
        x = rng.integers(-60, 61, (300, 6)) if trial % 2 else rng.integers(0, 12, (40, 6))[rng.integers(0, 40, 300)] * 50 + rng.integers(0, 3, (300, 6))
        history, state, measured = [x[:30].astype(np.int64)], (None, None, None), []
        for k in range(6):
            assigner = vector_codes.Assigner(history, groups=7)
            code, best, bounds, stamps = assigner(x, *state)
            measured.append(assigner.measured)
            distance = ((x[:, None, :] - history[-1][None]) ** 2).sum(2)
            assert (code == distance.argmin(1)).all() and (best == distance.min(1)).all()
            for g, (a, b) in enumerate(zip(assigner.ends, assigner.ends[1:])):
                for s in np.unique(stamps[:, g]):
                    rows = np.flatnonzero(stamps[:, g] == s)
                    then = np.sqrt(((x[rows, None, :] - history[s][None, a:b]) ** 2).sum(2))
                    others = np.where(np.arange(a, b) == code[rows, None], np.inf, then)
                    assert (bounds[rows, g] <= others.min(1, initial=np.inf)).all()
            state = (code, bounds, stamps)
            after = history[-1].copy()
            for j in np.unique(code):
                after[j] = x[code == j].sum(0) // (code == j).sum()
            history.append(after)
        assert all(m <= measured[0] for m in measured) and (trial % 2 or measured[-1] < measured[0] / 2)


def test_a_net_way_is_shorter_than_its_steps():
    there, and_back = np.array([[0, 0], [9, 9]]), np.array([[30, 40], [9, 9]])
    assigner = vector_codes.Assigner([there, and_back, there + 1], groups=2)
    assert assigner.net_ways[0] == pytest.approx([math.sqrt(2), math.sqrt(2)])
    assert assigner.net_ways[1][0] == pytest.approx(math.dist((30, 40), (1, 1))) and assigner.net_ways[2].tolist() == [0, 0]
