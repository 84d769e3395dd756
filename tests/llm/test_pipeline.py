"""The pipeline stage by stage, each on what the one before it kept, against plain versions."""

from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
from hard_rows import EXTRA, SCHEMA, hard_texts
from test_dedup import WORD, all_pairs, brute_groups
from test_text import low, targets_by_hand
import corpus_pipeline
from veloclima.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from veloclima.llm.oracle import ORACLES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")


def test_every_query_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run and set(ORACLES) <= set(names)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "source mixture",
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(repr, result.fetchall()))
    df = contract.queries()[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_stages(spark, tmp_path):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name.replace(" ", "-"))
        out = stage(spark, docs, str(DATA))
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = before, docs
        assert docs.columns[: len(documents.columns)] == documents.columns
        if name != "source mixture":
            assert docs.columns == documents.columns
    rows = lambda df: {r.doc_id: r for r in df.collect()}

    before, after = map(rows, kept["quality rules"])
    measured = {i: quality_rules.measure_text((r.text or "").encode()) for i, r in before.items()}
    for i, m in measured.items():
        n, _, symbols, _, _, repeated, upper, letters = m
        fails = n < 50 or 100 * repeated > 50 * n or symbols > n or (letters > 0 and 10 * upper > 8 * letters)
        assert (i in after) == (not fails)
        assert fails or after[i] == before[i]

    before, after = map(rows, kept["line dedup"])
    assert set(after) <= set(before)
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(kept["line dedup"][0]).collect()}
    for i, text in cut.items():
        assert (i in after) == bool(text == before[i].text or text.split())
        assert i not in after or after[i].text == text

    before, after = map(rows, kept["simhash near-dedup"])
    groups = {}
    for r in simhash.near_duplicates(kept["simhash near-dedup"][0]).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert set(after) == {min(g) for g in groups.values()} and all(after[i] == before[i] for i in after)

    before, after = map(rows, kept["benchmark decontamination"])
    bench = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for w in bench for k in range(max(1, len(w) - 9)) if w}
    for i, r in before.items():
        w = decontaminate.words_of(r.text.encode())
        hit = any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
        assert (i in after) == (not hit)

    before, after = map(rows, kept["source mixture"])
    mixed = {r.doc_id: r.copies for r in mixing.mix(kept["source mixture"][0]).collect()}
    assert {i: r.copies for i, r in after.items()} == {i: c for i, c in mixed.items() if c > 0}
    assert len(after) > 20


def fingerprint(text):
    w = WORD.findall(low(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stages_without_the_library(spark, tmp_path):
    """Line dedup, near-duplicates and the mix against rules written from their descriptions."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, before, after in through_stages(spark, docs, tmp_path, str(DATA)):
        before, after = before.orderBy("doc_id").collect(), {r.doc_id: r for r in after.collect()}
        if name == "line dedup":
            gone = all_pairs([r.text for r in before])
            for r, cut in zip(before, gone):
                left = "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in cut)
                assert (after[r.doc_id].text == left) if WORD.search(left) or not cut else r.doc_id not in after
            assert any(gone)
        if name == "simhash near-dedup":
            groups = brute_groups(np.array([fingerprint(r.text) for r in before], np.uint64))
            first = {}
            for r, g in zip(before, groups):
                first.setdefault(g, r.doc_id)
            assert set(after) == set(first.values())
        if name == "source mixture":
            sizes, taken = {}, {}
            for r in before:
                sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text))
            for r in after.values():
                assert 0 < r.copies <= 3 and r["size"] == len(WORD.findall(r.text)) and r.taken == r.copies * r["size"]
                taken[r.source] = taken.get(r.source, 0) + r.taken
            largest = max(len(WORD.findall(r.text)) for r in before)
            for source, target in targets_by_hand(sizes).items():
                assert abs(taken.get(source, 0) - target) <= largest
                assert all(abs(r.target - target) < 1e-6 * target for r in after.values() if r.source == source)


def documents_of(spark, rows):
    table = [(i, t, "en", f"src{n % 4}" if n % 5 else None, len(t or ""), *EXTRA) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(table, SCHEMA).repartition(3)


def through_stages(spark, docs, folder, sf_dir):
    """What each stage keeps, written and read as the pipeline does."""
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        yield name, before, docs


def benchmark_folder(spark, tmp_path, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "sf" / "benchmark.parquet"))
    return str(tmp_path / "sf")


def test_hard_rows_through_all_stages(spark, tmp_path):
    """Nulls, copies, repeated rows, very long texts and clashing names, against plain rules."""
    long = next(t for i, t in hard_texts() if i == 40)
    prose = [" ".join(long.split()[k * 400 : k * 400 + 90]) for k in range(1, 40)]
    rows = hard_texts() + [(100 + k, t) for k, t in enumerate(prose)]
    rows += [(200, prose[3]), (None, prose[3]), (201, prose[4] + " and"), (7, prose[5]), (7, prose[5]), (7, prose[6] + " tail of its own")]
    item = " ".join(prose[9].split()[20:40])
    sf_dir = benchmark_folder(spark, tmp_path, [(1, item), (2, None), (3, "!?"), (None, "a b c")])
    seen = {}
    for name, before, after in through_stages(spark, documents_of(spark, rows), tmp_path, sf_dir):
        seen[name] = before.collect(), after.collect()
        if name != "source mixture":
            assert after.columns == before.columns, name

    before, after = seen["quality rules"]
    passes = lambda t: len((t or "").split()) >= 50
    assert len(before) == len(rows) and all(passes(r.text) for r in after)
    lost = [r.text for r in before if passes(r.text) and repr(r) not in set(map(repr, after))]
    for text in lost:  # rejected for words that repeat, symbols or shouting
        w = text.split()
        windows = list(zip(w, w[1:], w[2:]))
        places = {p for k, x in enumerate(windows) if windows.count(x) > 1 for p in (k, k + 1, k + 2)} if len(w) < 2000 else ()
        letters = [c for c in text if c.isascii() and c.isalpha()]
        capitals = sum(c.isupper() for c in letters)
        assert 2 * len(places) > len(w) or sum(c in "#*$%&|<>" for c in text) > len(w) or 10 * capitals > 8 * len(letters)

    before, after = seen["line dedup"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    lines = {r.doc_id: set(r.text.split("\n")) for r in before if r.doc_id is not None and r.doc_id != 7}
    for r in after:
        if r.doc_id in lines:
            assert set(r.text.split("\n")) <= lines[r.doc_id]
    kept = [(r.doc_id, r.text) for r in after]
    assert (103, prose[3]) in kept and (200, prose[3]) not in kept and (None, prose[3]) not in kept  # the later copies lose their line

    before, after = seen["simhash near-dedup"]
    assert len({r.text for r in after}) == len(after)
    assert {r.text for r in after if r.doc_id and 100 <= r.doc_id < 139} >= {t for t in prose if sum(t == x for _, x in rows) == 1}

    before, after = seen["benchmark decontamination"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {109, 40} & {r.doc_id for r in before}

    before, after = seen["source mixture"]
    assert all(r.copies > 0 and r.taken == r.copies * r["size"] == r.copies * len(r.text.split()) for r in after)
    assert len({repr(r.source) for r in after}) > 1 and set(r["_KEY"] for r in after) == {"was key"}


def test_empty_tables_through_all_stages(spark, tmp_path):
    empty = documents_of(spark, [(1, "x")]).limit(0)
    for items in ([], [(1, "some ten words that nobody has ever written anywhere at all")]):
        sf_dir = benchmark_folder(spark, tmp_path / str(len(items)), items)
        for name, before, after in through_stages(spark, empty, tmp_path / str(len(items)), sf_dir):
            assert after.count() == 0 and set(before.columns) - {"size"} <= set(after.columns) | {"size"}, name
    few = documents_of(spark, [(1, None), (None, ""), (2, "too short")])
    folder = tmp_path / "few"
    assert [after.count() for _, _, after in through_stages(spark, few, folder, sf_dir)] == [0] * 5


def test_run_ends_like_the_stages(spark):
    assert {"doc_id", "text", "copies", "taken", "target"} <= set(corpus_pipeline.run(spark, str(DATA)).columns)
