"""Operators on single documents and the mix, each against a plain version."""

import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hard_rows import empty, hard, multiset, texts  # noqa: F401
from veloclima.llm import decontaminate, html_text, mixing, pii, quality_model, quality_rules
from veloclima.llm._tables import Written, row_key

WORD = re.compile(r"[^\x20\x09-\x0D]+")



# --- rules -------------------------------------------------------------------------------


def measures_by_hand(t):
    t = t or ""
    w = WORD.findall(t)
    windows = list(zip(w, w[1:], w[2:]))
    places = {p for k, x in enumerate(windows) if windows.count(x) > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    upper, letters = len(re.findall("[A-Z]", t)), len(re.findall("[A-Za-z]", t))
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), dup, len(places), upper, letters


def test_ledger_and_policies(hard, empty, texts):
    rows = quality_rules.ledger(hard)
    assert "size" in rows.columns and rows.columns.count("n_words") == 1
    small = {i: t for i, t in texts if t is None or len(t) < 8000}
    got = {r.doc_id: r for r in rows.collect() if r.doc_id in small and r.doc_id != 22 and r.doc_id is not None}
    for i, r in got.items():
        want = measures_by_hand(small[i])
        assert tuple(r[m] for m in quality_rules.MEASURES) == want, i
        env = dict(zip(quality_rules.MEASURES, want))
        bits = sum(1 << b for b, rule in enumerate(quality_rules.RULES.values()) if eval(rule, {}, env))
        assert r.failed_bits == bits
    kept = quality_rules.apply_policy(hard, "v1")
    assert kept.columns == hard.columns
    assert {41, 42, 31}.isdisjoint({r.doc_id for r in kept.collect()})
    assert quality_rules.ledger(empty).count() == 0 and quality_rules.apply_policy(empty).count() == 0


def test_ablations(hard):
    rows = quality_rules.ledger(hard)
    bits = [r.failed_bits for r in rows.collect()]
    names = list(quality_rules.RULES)
    for policy in quality_rules.POLICIES:
        whole = quality_rules.mask(policy)
        for r in quality_rules.ablations(rows, policy).collect():
            bit = 1 << names.index(r.rule)
            assert r.n_failed == sum(bool(b & bit) for b in bits)
            assert r.n_only == sum((b & whole) == bit for b in bits)
            assert r.n_kept_without == sum((b & whole & ~bit) == 0 for b in bits)


# --- decontamination -----------------------------------------------------------------------

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.mark.parametrize("shard_bytes", [4_000_000, 400])
def test_hits_items_and_offsets(spark, hard, empty, texts, shard_bytes):
    long = next(t for i, t in texts if i == 40)
    w = long.split()
    items = [
        (1, " ".join(w[100:130]).upper()), (2, " ".join(w[110:115])), (3, "!?"), (4, None), (5, "É " + "é" * 3 + "-x"),
        (1, " ".join(w[100:130]).upper()), (None, ", ".join(w[125:150])), (7, "never seen anywhere in the texts above at all today"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = [(900, "Before. " + ";".join(w[100:112]) + " -- ÉÉ! after"), (901, "É ééé-X")]
    docs = hard.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    windows = {}
    for i, t in items:
        own = NORMAL.findall(low(t))
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add("" if i is None else str(i))
    want = []
    for i, t in [*texts, *extra]:
        own = NORMAL.findall(low(t))
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(own[k : k + n])]
        want.append((i, len(own), len(hit), sorted(ids)))
    marked = decontaminate.mark(docs, bench, shard_bytes=shard_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in marked.collect()]
    assert multiset(got) == multiset(want)
    assert sum(r[2] > 0 for r in want) == 3
    found = decontaminate.original_spans(decontaminate.scan(docs, bench, shard_bytes=shard_bytes)).where("found.n_hit > 0")
    for r in found.collect():
        cut = [low(r.text[s:e]) for s, e in r.original_spans]
        assert all(NORMAL.match(x) and NORMAL.findall(x)[-1] == x[-len(NORMAL.findall(x)[-1]) :] for x in cut)
        assert sum(len(NORMAL.findall(x)) for x in cut) == r.found.n_hit
    clean = decontaminate.drop_contaminated(hard, bench, shard_bytes=shard_bytes)
    assert clean.columns == hard.columns and clean.count() == len(texts) - 1
    assert decontaminate.mark(empty, bench).count() == 0
    assert decontaminate.mark(hard, bench.limit(0)).where("contaminated").isEmpty()


# --- mix -------------------------------------------------------------------------------------


def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_copies(spark, seed):
    rng = random.Random(seed)
    rows = [
        (k, rng.choice(["a", "b", "c", "d", "é", "Z", None]), " ".join(["w"] * int(rng.lognormvariate(4, 1.2))))
        for k in range(900)
    ]
    rows += [(2000, "lone", "x " * 40), (2001, "bare", None), (2002, "bare", "")]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    got = mixed.collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets_by_hand(sizes)
    taken = {}
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size and abs(r.copies - r.rate) < 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, rel=0.02, abs=45 if s == "lone" else 5)
    # rates of a source are one exponential of the size, cut at three
    for s in ("a", "b", "c"):
        slope = [np.log(r.rate) / r.size for r in got if r.source == s and r.size and 1e-6 < r.rate < 3]
        assert np.ptp(slope) < 1e-9
        assert sum(r.rate * r.size for r in got if r.source == s) == pytest.approx(want[s], rel=1e-8)
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, source string, text string")).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_sources_of_like_sizes_reach_their_targets(spark):
    rng = random.Random(5)
    rows = [(k, "abcd"[k % 4], "w " * rng.randint(64, 127)) for k in range(12_000)]
    rows += [(20_000 + k, "e", "w " * 100) for k in range(3000)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(3, 5, 3, 5, 4))
    got = mixed.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert len(got) == 5
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) < 127, r
    assert mixed.where("abs(copies - rate) >= 2").isEmpty()


def test_hard_rows_mix(hard, empty, texts):
    rows = mixing.mix(hard)
    assert set(rows.columns) == set(hard.columns) | set(mixing.RESULT)
    assert rows.count() == len(texts)
    assert mixing.mix(empty).count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


# --- personal data -----------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_by_hand(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == "email"
                or (kind == "ip" and all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 13 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((kind, m.start(), m.end()))
    return out


PIECES = [
    "a", "b.c", "@", "x@y.z", "1.2.3.4", "5", "255.0.0.1", "4111 1111 1111 1111", "4111111111111111", "+1 (366) 555-9807",
    " ", ",", ".", "-", "+", "_", "é", "\n", "999.1.1.1.2", "00.01.002.255", "a@b.c_d@e.f", "a@b.c@d.e", "1 2-3", "😀", "(", ")",
]


def test_base_spans_and_added_ones(spark, empty):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))) for k in range(1500)]
    rows += [(k, f'noise {k} token = "{hashlib.sha1(str(k).encode()).hexdigest()}" more') for k in range(2000, 2100)]
    rows += [(k, f"see page {k} of the report and chapter {k % 9}") for k in range(3000, 3200)]
    rows += [(5000, None), (5001, ""), (None, "me@x.org"), (5002, "dup@x.org"), (5002, "dup@x.org")]
    rows += [(5003, "1" * 5000 + ".1" * 3 + "@"), (5004, "a" * 20_000 + "@b" + ".c" * 5000), (5005, "1-" * 20_000)]
    df = spark.createDataFrame([(*r, "keep me") for r in rows], "doc_id long, text string, `_Key` string")
    found = pii.find_personal_data(df)
    assert "_Key" in found.columns
    got = found.collect()
    want = {(i, t): base_by_hand(t) for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        assert [(s.kind, s.start, s.end) for s in r.personal or () if s.base] == want[r.doc_id, r.text]
    secrets = sum(any(s.kind == "secret" for s in r.personal or ()) for r in got if r.doc_id and 2000 <= r.doc_id < 2100)
    assert secrets >= 95
    assert not any(r.personal for r in got if r.doc_id and 3000 <= r.doc_id < 3200)
    assert pii.find_personal_data(empty).count() == 0
    assert not re.search("Python|Pandas|ArrowEval", found._jdf.queryExecution().executedPlan().toString())
    masked = {r.doc_id: r.text for r in pii.mask(df.where("doc_id >= 2000 or doc_id is null")).collect()}
    assert masked[None] == "<email>" and masked[2000] == 'noise 2000 token = "<secret>" more' and masked[5000] is None


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.3
    accuracy = [0.95, 0.8, 0.65]
    votes = [np.where(rng.random(20_000) < 0.3, 0, np.where(rng.random(20_000) < a, truth, ~truth) * 2 - 1) for a in accuracy]
    patterns, n = np.unique(np.column_stack(votes), axis=0, return_counts=True)
    model = pii.Reliability([(tuple(p), int(c)) for p, c in zip(patterns.tolist(), n)])
    assert model.prior == pytest.approx(0.3, abs=0.05)
    for k, a in enumerate(accuracy):
        right = model.tables[0][k][2] / (model.tables[0][k][0] + model.tables[0][k][2])
        assert right == pytest.approx(a, abs=0.06)


# --- quality model ------------------------------------------------------------------------------


def labelled(spark, n=1200):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for k in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 300))]
        bad = k % 4 == 0
        rows.append((k, " ".join(x + "%%%" if bad else x for x in w)))
        labels.append((k, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_scores_tell_good_from_bad(spark, hard, empty):
    documents, labels = labelled(spark)
    model = quality_model.fit(documents, labels)
    held = quality_model.score(documents, model).where(quality_model.is_held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    assert len(held) > 150
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert np.mean([(r.score - r.quality) ** 2 for r in held]) < 0.05
    rows = quality_model.score(hard, model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert quality_model.score(empty, model).count() == 0
    # held-out labels are not read
    flipped = labels.withColumn("quality", F.when(quality_model.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_model.fit(documents, flipped)
    assert again.dictionaries == model.dictionaries and np.allclose(again.curve, model.curve)


def test_scores_without_two_labels(spark, hard, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_model.score(hard, quality_model.fit(hard, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(k, 1) for k in range(60)] + [(3, None), (4, 7)], "doc_id long, quality int")
    assert {r.score for r in quality_model.score(hard, quality_model.fit(hard, ones)).collect()} == {1.0}
    few = spark.createDataFrame([(10, 1), (11, 1), (12, 1), (50, 0), (52, 0), (53, 0), (None, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_model.score(hard, quality_model.fit(hard, few)).collect())


# --- pages ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        paragraphs = [" ".join(rng.choice(["rain", "fell", "over", "the", "old", "town", "again"]) for _ in range(rng.randint(4, 60))) + "." for _ in range(rng.randint(2, 9))]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        rows.append((k, f"<html><body><nav><ul><li><a href=/>menu</a></ul></nav><article><h1>Title {k}</h1>{body}</article><footer>&copy; us</footer></body></html>", "\n".join([f"Title {k}", *paragraphs])))
    return spark.createDataFrame(rows, "page_id long, html string, want string")


@pytest.fixture(scope="module")
def trees(pages):
    return html_text.fit(pages)


def test_pages_of_known_text(pages, trees):
    got = html_text.main_text(pages, trees=trees).collect()
    assert all(r.text == r.want and r.n_chars == len(r.want) for r in got)


def test_held_out_layouts(trees):
    rng = random.Random(77)
    right = 0
    for _ in range(150):
        page, main = html_text.layout(rng, [f"{s} {k}" for k, s in enumerate(html_text._STAND_IN * 2)])
        lines = set(html_text.extract_texts([page], trees)[0].split("\n"))
        right += lines == main
    assert right >= 130


def test_hard_pages(spark, trees):
    cases = [
        (None, ""), ("", ""), ("   ", ""), ("<script>var a='</p>';</script>", ""), ("<!-- only", ""),
        ("<article><p>a &amp; b&nbsp;&nbsp;c<br>d\n\te</p><p>second <b>bold</b> text that goes on</article>", "a & b c d e\nsecond bold text that goes on"),
    ]
    cases += [("<div>" * 3000 + "deep text here", None), ("<p>" + "word " * 50_000, None), ("<" * 5000, None), ("<a href='" + "x" * 50_000, None)]
    df = spark.createDataFrame([(k, h, "t", 1) for k, (h, _) in enumerate(cases)], "page_id long, html string, text string, N_CHARS int")
    rows = {r.page_id: r for r in html_text.main_text(df, trees=trees).collect()}
    assert len(rows) == len(cases)
    for k, (_, want) in enumerate(cases):
        assert want is None or rows[k].text == want
    assert html_text.main_text(df.limit(0), trees=trees).count() == 0


def test_only_raw_text_is_skipped(trees):
    page = "<html><body><nav><a href=/>menu</a></nav><article><h1>Title</h1>%s<p>The rain fell over the old town again, and again.</p></article></body></html>"
    after = "The rain fell over the old town again, and again."
    formula = "<p>The area is <math><mi>a</mi><mo>=</mo><mrow><mi>b</mi><mi>c</mi></mrow><annotation>a=bc</annotation></math> as all know here.</p>"
    assert html_text.extract_texts([page % formula], trees) == [f"Title\nThe area is a=bc as all know here.\n{after}"]
    for tag in ("math", "svg", "object", "audio", "video", "canvas", "select", "annotation"):
        assert after in " ".join(t for _, t in html_text.parse(page % f"<p>Stray <{tag}> tag.</p>")[1]), tag
        inside = " ".join(t for _, t in html_text.parse(page % f"<p>It is <{tag}>inside</{tag}> here.</p>")[1])
        assert ("inside" in inside) == (tag not in ("select", "annotation")) and after in inside
    for tag in ("math", "svg"):
        assert html_text.extract_texts([page % f"<p>Stray <{tag}> tag stands here.</p>"], trees) == [f"Title\nStray tag stands here.\n{after}"]
    assert all(after not in t for _, t in html_text.parse(page % "<script>")[1])


def test_nothing_is_kept_below_what_is_left_out():
    nodes, runs = html_text.parse("<div><section><p>one</p></section><p>two</p></div>")
    own, _ = html_text.features(nodes)
    rng = np.random.default_rng(0)
    for _ in range(200):
        kept = html_text.decode(nodes, own, rng.random(len(own)))
        assert all(nodes[k].parent in kept for k in kept if k)
    assert html.unescape("&copy;") == "©" and runs[0][1] == "one"


def test_row_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([(None, None), (None, ""), (0, None), (0, "")], "a long, b string")
    assert df.select(row_key("a", "b")).distinct().count() == 4
    kept = Written(spark, "t")(df, "one")
    assert kept.count() == 4
