"""Inputs on which a careless step takes the square of its time, or all of its memory."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hard_rows import empty, hard, multiset, texts  # noqa: F401
from test_dedup import counts, uncovered
from test_text import base_by_hand
from veloclima.llm import automaton, decontaminate, html_text, line_dedup, pii, quality_model, simhash, substring_dedup, suffix_dedup
from veloclima.llm import _repeats, _tables
from veloclima.llm._tables import Written

# --- pages -----------------------------------------------------------------------------------

BROKEN = {
    "tags that never end": "<a",
    "tags and text": "a <b c",
    "selections": "<select>",
    "comments": "<!--",
    "quotes": '<a "',
    "quoted ends": '<a ">" ',
    "two quotes": "<a \"'>",
    "mixed quotes": "<a \"x\"'>",
    "inline": "<b>",
    "lists": "<li>",
    "heads": "<head>",
    "signs": "<",
    "references": "&",
    "scripts": "<script ",
    "nested": "<div>",
}


@pytest.mark.parametrize("name", BROKEN)
def test_broken_pages_take_linear_time(name):
    piece = BROKEN[name]
    seconds = []
    for size in (1 << 18, 1 << 20):
        started = time.process_time()
        html_text.parse(piece * (size // len(piece)))
        seconds.append(time.process_time() - started)
    assert seconds[1] < max(2, 8 * seconds[0])  # four times the page


@pytest.mark.parametrize("tail", ["</x>", "<p></p>", "<li></li>", "<tr></tr>"])
def test_deep_pages_take_linear_time(tail):
    started = time.process_time()
    nodes, _ = html_text.parse("<ul><li><table>" + "<div>" * 20_000 + tail * 60_000)
    assert time.process_time() - started < 8 and len(nodes) > 20_000


def shape(page):
    nodes, runs = html_text.parse(page)
    return [(nodes[k].tag, text) for k, text in runs]


def test_markup_as_browsers_take_it():
    """Pages that no layout of the training data makes."""
    assert shape("<p>one<p>two</p>three") == [("p", "one"), ("p", "two"), ("body", "three")]
    assert shape("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("body", "e")]
    assert shape("<table><tr><td>1<td>2<tr><td>3</table>") == [("td", "1"), ("td", "2"), ("td", "3")]
    assert shape("<dl><dt>k<dd>v<dt>l</dl>") == [("dt", "k"), ("dd", "v"), ("dt", "l")]
    assert shape('<p title="a > b">text</p>') == [("p", "text")]
    assert shape("<p title='x>y' class=\"q'r\">text</p>") == [("p", "text")]
    assert shape('<p title="never closed>text</p>') == [("p", "text")]
    assert shape("1 < 2 and <b>3</b> > 2 <") == [("body", "1 < 2 and 3 > 2 <")]
    assert shape("a<!-- > -- --><i>b</i><!-->c-->d") == [("body", "abd")]
    assert shape("a<?php x ?>b</>c<!doctype html>d") == [("body", "abcd")]
    assert shape("<div>a</section>b</div>c") == [("div", "a"), ("div", "b"), ("body", "c")]
    assert shape("<SCRIPT>if (a < b) '<p>'</Script >t") == [("body", "t")]
    assert shape("<script>never ends <p>t</p>") == []
    assert shape("x <p") == [("body", "x <p")] and shape("x </p") == [("body", "x")]
    assert shape("<x-card/>y<p/>z") == [("body", "y"), ("p", "z")]


# --- personal data -----------------------------------------------------------------------------


def test_a_text_with_very_many_spans(spark):
    text = " ".join(f"u{k}@x.org" if k % 2 else f"10.{k % 250}.7.{k % 199} tok=ab12cd34ef56gh78ij{k}" for k in range(30_000))
    df = spark.createDataFrame([(1, text), (2, "me@x.org")], "doc_id long, text string")
    found = pii.find_personal_data(df)
    started = time.monotonic()
    rows = {r.doc_id: r.personal for r in found.collect()}
    assert time.monotonic() - started < 150  # a frame that looks ahead takes ten times that
    assert [(s.kind, s.start, s.end) for s in rows[1] if s.base] == base_by_hand(text)
    spans = pii.personal_spans(df, Written(spark, "t"))
    assert "unboundedfollowing" not in spans._jdf.queryExecution().optimizedPlan().toString().lower()


def test_values_are_common_by_their_share(spark):
    rows = [(k, "ring +1 (366) 555-9807 or +1 (366) 555-%04d" % k) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.candidates(df)
    share = lambda n, common: {
        r.value for r in pii.votes(found, n, common).where("vote_frequency = -1 and kind = 'phone'").select("value").distinct().collect()
    }
    assert share(40, 0.5) == {"+1 (366) 555-9807"} and share(40, 1.0) == set()
    assert share(40, 0.0) == {"+1 (366) 555-9807"}  # one document alone is never a share


# --- quality model -----------------------------------------------------------------------------


def test_the_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    rng = random.Random(7)
    some = lambda bad: " ".join("".join(rng.choice("abcde") for _ in range(6)) + "%" * bad for _ in range(60))
    base = [(k, some(k % 3 == 0)) for k in range(120)]
    labels = [(k, int(k % 3 != 0)) for k in range(120)]
    layout = "doc_id long, text string", "doc_id long, quality int"
    plain = quality_model.fit(spark.createDataFrame(base, layout[0]), spark.createDataFrame(labels, layout[1]))
    many = spark.createDataFrame(base * 30 + [(5, None), (None, "x"), (7, "")], layout[0]).repartition(4)
    twice = spark.createDataFrame(labels * 3 + [(None, 1), (3, None)], layout[1])
    _, rows = quality_model.sampled_rows(many, twice, "text", "doc_id", "quality", 20)
    got = rows.collect()
    assert len(got) <= 40 and len({r.id for r in got}) == len(got)
    model = quality_model.fit(many, twice)
    assert model.dictionaries == plain.dictionaries and np.allclose(model.curve, plain.curve)
    # ids with both labels are learned from under neither
    both = spark.createDataFrame(labels + [(k, int(k % 3 == 0)) for k in range(60)], layout[1])
    left = {r.id for r in quality_model.labelled(both, "doc_id", "quality").collect()}
    assert left and min(left) >= 60
    # different texts under one id: the same one each time
    other = spark.createDataFrame([(k, t) for k, t in base] + [(k, t + " more") for k, t in base], layout[0])
    once, again = (quality_model.fit(other.repartition(n, "text"), twice) for n in (2, 5))
    assert once.dictionaries == again.dictionaries


def test_scores_by_hand(spark):
    """The score from the two dictionaries and the curve, with the library's own compressor calls."""
    import zstandard

    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice("alpha beta gamma delta %% ##".split()) for _ in range(rng.randint(1, 400)))) for k in range(80)]
    rows += [(100, None), (101, ""), (102, "é" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int("%%" not in t[:40])) for k, t in rows[:80]], "doc_id long, quality int")
    model = quality_model.fit(df, labels)
    bad, good = (zstandard.ZstdCompressionDict(d) for d in model.dictionaries)

    def size(held, piece):
        packed = zstandard.ZstdCompressor(level=3, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False).compress(piece)
        assert zstandard.ZstdDecompressor(dict_data=held).decompress(packed, max_output_size=len(piece)) == piece
        return len(packed)

    for r in quality_model.score(df, model).collect():
        data = (r.text or "").encode()
        a, b = (sum(size(held, data[k : k + 1024]) for k in range(0, len(data), 1024)) for held in (bad, good))
        d, ratio = (10 * (a - b) / (a + b), np.log((a + b) / (2 * len(data)))) if data else (0.0, 0.0)
        margin = float(np.dot(model.curve, [1, d, d * d, ratio, ratio * ratio, d * ratio]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -40, 40))), abs=1e-9)
        assert r.predicted == int(r.score >= 0.3)


# --- repeated strings under common anchors -------------------------------------------------------


@pytest.mark.parametrize("length", [60, 150, 198, 205, 320])
def test_a_passage_in_many_contexts(spark, length):
    """One passage in hundreds of different contexts, some of them alike on one side."""
    rng = random.Random(length)
    some = lambda n: bytes(rng.choice(b"abcdefghijklmnop ") for _ in range(n)).decode()
    passage, sides = some(length), [some(rng.randint(1, 190)) for _ in range(12)]
    rows = []
    for k in range(260):
        before = rng.choice(sides) if k % 3 else some(rng.randint(0, 150))
        after = rng.choice(sides) if k % 4 else some(rng.randint(0, 150))
        rows.append((k, before + passage + after))
    data = [t.encode() for _, t in rows]
    seen = counts(data, 200)
    want = [(i, bytes(x for x, g in zip(b, uncovered(b, 200, seen)) if not g)) for (i, _), b in zip(rows, data)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for kinds in (2, 40):
        got = [(r.doc_id, bytes(r.kept)) for r in suffix_dedup.dedup_bytes(df, kinds=kinds, bucket_bytes=20_000).collect()]
        assert multiset(got) == multiset(want)


def test_rows_stay_few_per_context(spark):
    """Anchored again, a context makes a few rows a level, however many share its anchor."""
    rng = random.Random(1)
    some = lambda n: bytes(rng.choice(b"abcdefghijklmnop ") for _ in range(n)).decode()
    passage = some(170)
    made = {}
    for n in (100, 400):
        rows = [(k, some(120) + passage + some(120)) for k in range(n)]

        class Seen(Written):
            def __call__(self, df, name):
                out = super().__call__(df, name)
                made.setdefault(name, {})[n] = out.count()
                return out

        df = spark.createDataFrame(rows, "doc_id long, text string")
        suffix_dedup.removed_spans(df, Seen(spark, "t"), "text", "doc_id", 200, 20, 400_000).collect()
    assert {name for name in made if name.startswith("rows")} >= {"rows", "rows-64"}
    for name, by_n in made.items():
        assert by_n.get(400, 0) <= 6 * max(20, by_n.get(100, 0)), name
    assert made["rows-64"][400] <= 5 * made["left"][400]


@pytest.mark.parametrize("width", suffix_dedup.WIDTHS)
def test_equal_windows_have_equal_second_anchors(width):
    rng = np.random.default_rng(width)
    codes = suffix_dedup.byte_names()
    passage = rng.integers(0, 4, 260).astype(np.uint8).tobytes()
    names = {}
    for _ in range(60):
        a, b = rng.integers(0, 40, 2)
        body = rng.integers(0, 4, a).astype(np.uint8).tobytes() + passage[: 230 + b // 2]
        # the anchor is the passage's place 120; starts with it inside their window
        ahead = a + 120
        first = max(0, ahead - 184)
        part = np.array([7]), np.array([ahead - first])
        _, name, _, head, last, distance = suffix_dedup.second_anchors([body[first:]], *part, 200, width, codes)
        for n, s, e, d in zip(name.tolist(), head.tolist(), last.tolist(), distance.tolist()):
            assert e - s < width and d == ahead - first - s
            for k in range(s, e + 1):
                window = body[first + k : first + k + 200]
                if len(window) == 200 and first + k <= ahead:
                    assert names.setdefault((window, ahead - first - k), n) == n


def test_anchors_of_many_windows_at_once():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    begin = rng.integers(0, 4800, 300)
    want = [int(suffix_dedup.anchors(data[b : b + 200], 200)[0][0]) for b in begin]
    assert suffix_dedup.anchors_ahead(data, begin, 200).tolist() == want


# --- two hashes for a row ------------------------------------------------------------------------


@pytest.fixture
def first_half_collides(monkeypatch):
    """All rows share the first of their two hashes."""
    real = _tables.row_key

    def same(*columns):
        return F.when(real(*columns).isNotNull(), F.lit(5).cast("long"))

    monkeypatch.setattr(_tables, "row_key", same)
    monkeypatch.setattr(_repeats, "row_key", same)


def results(hard):
    return {
        "words": multiset((r.doc_id, r.kept) for r in substring_dedup.dedup_substrings(hard).collect()),
        "bytes": multiset((r.doc_id, bytes(r.kept)) for r in suffix_dedup.dedup_bytes(hard).collect()),
        "lines": multiset((r.doc_id, r.text) for r in line_dedup.dedup_lines(hard).collect()),
        "kept": sorted(str(r.doc_id) for r in simhash.keep_first(hard).collect()),
        "personal": multiset((r.doc_id, r.text, r.personal) for r in pii.find_personal_data(hard).collect()),
    }


@pytest.fixture(scope="module")
def unharmed(hard):
    return results(hard)


def test_a_collision_of_one_half_changes_nothing(hard, unharmed, first_half_collides):
    assert hard.select(_tables.row_identity("doc_id", "text").alias("k")).select("k.a").distinct().count() == 1
    assert results(hard) == unharmed


# --- lines ---------------------------------------------------------------------------------------


def test_a_first_holder_goes_once_to_each_bucket(spark):
    """A long first document that many share travels by the bucket, not by the pair."""
    rng = random.Random(2)
    lines = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(16)) for _ in range(300)]
    rows = [(0, "\n".join(lines))] + [(k, f"own words of {k}\n" + lines[k % 300] + f"\nand an end {k}") for k in range(1, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tables = Written(spark, "t")
    docs = df.select(
        _tables.row_identity("doc_id", "text").alias("key"), "doc_id", line_dedup.line_hashes("text").alias("l")
    ).select("key", "doc_id", "l.hashes", "l.words")
    docs = tables(docs, "docs")
    first = docs.where("doc_id = 0").select(F.col("key").alias("first")).first().first
    pairs = docs.where("doc_id > 0").select(F.struct(F.lit(first.a).alias("a"), F.lit(first.b).alias("b")).alias("first"), "key")
    for meet in (60, 10_000):
        cut = line_dedup.aligned(tables(pairs, f"pairs{meet}"), docs, tables, meet)
        assert Counter(len(r.cut) for r in cut.collect()) == {1: 199}
    whole = line_dedup.dedup_lines(df).collect()
    assert {r.n_removed for r in whole if r.doc_id} == {1} and not re.search("Cartesian|NestedLoop", cut._jdf.queryExecution().executedPlan().toString())


# --- benchmark windows ---------------------------------------------------------------------------


@pytest.mark.parametrize("segment", [1, 3, 17, 512])
def test_the_automaton_finds_every_pattern(monkeypatch, segment):
    monkeypatch.setattr(automaton, "SEGMENT", segment)
    rng = np.random.default_rng(segment)
    for _ in range(60):
        width = int(rng.integers(2, 6))
        lengths = rng.choice(np.arange(1, 6), rng.integers(1, 4), replace=False)
        patterns = [rng.integers(1, width, (rng.integers(1, 6), n)) for n in lengths]
        owners = rng.integers(0, 9, sum(map(len, patterns)))
        words = rng.integers(0, width, rng.integers(0, 60))
        built = automaton.Automaton(patterns, owners, width)
        want = {
            (i + len(row) - 1, len(row), int(o))
            for row, o in zip([r for p in patterns for r in p], owners)
            for i in range(len(words) - len(row) + 1)
            if (words[i : i + len(row)] == row).all()
        }
        got = list(zip(*(x.tolist() for x in built.hits(words))))
        assert set(got) == want and len(got) == len(want)
    assert len(automaton.Automaton([], np.zeros(0, np.int64), 1).hits(np.zeros(5, np.int64))[0]) == 0


def test_an_automaton_stays_small(spark):
    rng = random.Random(6)
    pieces = [(f"i{k}", " ".join(f"w{rng.randint(0, 4000)}" for _ in range(200))) for k in range(100)]
    numbers, items, built = decontaminate.window_automaton(pieces)
    windows = 100 * 191
    assert len(items) == 100 and built.bytes() < 220 * windows and len(built.keys) <= 10 * windows


def test_many_shards_write_hits_and_no_texts(spark, monkeypatch):
    rng = random.Random(4)
    some = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    items = [(k, some(rng.choice([4, 12, 2500]))) for k in range(30)]
    docs = [(k, some(50) + " " + " ".join(items[k % 30][1].split()[:40]) + " " + some(20) if k % 2 else some(80)) for k in range(60)]
    docs += [(60, None), (61, items[3][1]), (61, items[3][1])]
    written = {}

    class Seen(Written):
        def __call__(self, df, name):
            written[name] = df.columns
            return super().__call__(df, name)

    monkeypatch.setattr(decontaminate, "Written", Seen)
    extra = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, _items string, _key int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (decontaminate.mark(extra, bench, shard_bytes=n).collect() for n in (1 << 30, 3000))
    assert sum(name.startswith("hits") for name in written) > 10
    assert all("text" not in columns for name, columns in written.items() if name != "pieces")
    assert multiset(one) == multiset(many) and sum(r.contaminated for r in one) > 25
    assert len(many) == len(docs) and many[0]._items == "x"
