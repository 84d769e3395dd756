"""Operators that look for repeats, each against a plain search."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hard_rows import empty, hard, multiset, texts  # noqa: F401
from veloclima.llm import line_dedup, simhash, substring_dedup, suffix_dedup
from veloclima.llm._repeats import RangeHash
from veloclima.llm._tables import Written
from veloclima.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")



def uncovered(sequence, window, seen):
    gone = [False] * len(sequence)
    for k in range(len(sequence) - window + 1):
        if seen[tuple(sequence[k : k + window])] > 1:
            gone[k : k + window] = [True] * window
    return gone


def counts(sequences, window):
    return Counter(tuple(s[k : k + window]) for s in sequences for k in range(len(s) - window + 1))


def test_words_in_repeated_windows(hard, empty, texts):
    split = [WORD.findall(t or "") for _, t in texts]
    seen = counts(split, 35)
    want = []
    for (i, _), w in zip(texts, split):
        gone = uncovered(w, 35, seen)
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    rows = substring_dedup.dedup_substrings(hard)
    assert {"size", "lang", "_KEY"} <= set(rows.columns)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows.collect()]
    assert multiset(got) == multiset(want)
    assert sum(r[2] for r in want) > 500
    assert substring_dedup.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("kinds", [500, 1])
def test_bytes_under_repeated_strings(hard, empty, texts, kinds):
    data = [(t or "").encode() for _, t in texts]
    seen = counts(data, 200)
    want = []
    for (i, _), b in zip(texts, data):
        gone = uncovered(b, 200, seen)
        runs = len(re.findall("1+", "".join("01"[g] for g in gone)))
        want.append((i, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    rows = suffix_dedup.dedup_bytes(hard, kinds=kinds, bucket_bytes=5000)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows.collect()]
    assert multiset(got) == multiset(want)
    assert suffix_dedup.dedup_bytes(empty, kinds=kinds).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40).map(str.encode), min_size=1, max_size=6))
def test_matching_statistics(texts):
    index = suffix_dedup.RunIndex(texts)
    got = index.matching_statistics().tolist()
    want = []
    for n, t in enumerate(texts):
        for k in range(len(t)):
            best = 0
            for m, other in enumerate(texts):
                for j in range(len(other)):
                    if (m, j) != (n, k):
                        length = 0
                        while length < min(len(t) - k, len(other) - j) and t[k + length] == other[j + length]:
                            length += 1
                        best = max(best, length)
            want.append(best)
    assert got == want
    assert index.heads.sum() <= max(1, sum(map(len, texts)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=35, max_size=160), st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=60))
def test_a_window_has_the_same_anchor_wherever_it_stands(window, before, after):
    names = np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    alone, among = names[window], names[before + window + after]
    place, name = substring_dedup.anchors(alone)
    other_place, other_name = substring_dedup.anchors(among)
    shift = len(before)
    assert (other_place[shift : shift + len(place)] - shift == place).all()
    assert (other_name[shift : shift + len(place)] == name).all()


def test_range_hashes():
    names = np.random.default_rng(0).integers(0, 9, 500).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    names = np.concatenate([names, names])
    ranges = RangeHash(names)
    start = np.arange(400)
    assert (ranges(start, start + 90) == ranges(start + 500, start + 590)).all()
    assert len(set(ranges(start, start + 90).tolist())) == 400


def brute_groups(values, distance=2):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(values)):
        for b in np.nonzero(np.bitwise_count(values ^ values[a]) <= distance)[0].tolist():
            root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(values))]


def test_fingerprints_and_groups(hard, empty, texts):
    prints = []
    for _, t in texts:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = brute_groups(np.array(prints, np.uint64))
    name = {}
    for (i, _), g in zip(texts, group):
        name[g] = min((x for x in (name.get(g), i) if x is not None), default=None)
    want = [(i, f"{p:016x}", name[g]) for (i, _), p, g in zip(texts, prints, group)]
    got = [tuple(r) for r in simhash.near_duplicates(hard).collect()]
    assert multiset(got) == multiset(want)
    kept = simhash.keep_first(hard)
    assert kept.columns == hard.columns
    assert kept.count() == len(set(group))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_gray_search_finds_every_neighbour(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 3000), dtype=np.uint64)
    values = np.unique(np.concatenate([centres, centres[rng.integers(0, 300, 3000)] ^ flips[0] ^ flips[1] ^ flips[2]]))
    members = values[np.argsort(simhash.gray_rank(values))]
    found = {(int(values[p]), int(members[n])) for ps, ns in simhash.GrayTree(members, ~members).search(values, 2) for p, n in zip(ps, ns)}
    want = {(int(a), int(b)) for a in values for b in values[np.bitwise_count(values ^ a) <= 2]}
    assert found == want
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    linked = simhash.links(df, Written(spark, "t"))
    roots = {r.node: r.root for r in components(linked, Written(spark, "t")).collect()}
    signed = values.view(np.int64)
    groups = brute_groups(values)
    least = {}
    for v, g in zip(signed.tolist(), groups):
        least[g] = min(least.get(g, v), v)
    assert all(roots.get(v, v) == least[g] for v, g in zip(signed.tolist(), groups))


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    roots = components(spark.createDataFrame(links, "a long, b long"), Written(spark, "t")).collect()
    assert {r.node: r.root for r in roots} == {**{k: 1 for k in range(2, 201)}, **{1000 + k: 1000 for k in range(1, 300)}}
    assert components(spark.createDataFrame([], "a long, b long"), Written(spark, "t")).isEmpty()


def test_patience():
    align = line_dedup.patience
    assert align([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert align([1, 2, 3, 4], [9, 2, 8, 4]) == [(1, 1), (3, 3)]
    assert align([1, 2, 3], [3, 1, 2]) in ([(0, 1), (1, 2)], [(2, 0)])
    assert align([0, 0, 7, 0], [0, 7, 0, 0]) and align([], [1]) == []
    assert align([5, 1, 1, 6], [7, 1, 1, 8]) == [(1, 1), (2, 2)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
def test_patience_pairs_equal_lines_in_order(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a and a == b:
        assert len(pairs) == len(a)


def lines_by_hand(texts):
    """The documented rules, document by document."""
    order = sorted({(i is None, i or 0, t) for i, t in texts if t is not None})
    split = {x: [(line.strip(" \t\x0b\f\r"), len(WORD.findall(line))) for line in x[2].split("\n")] for x in order}
    holders = {}
    for x in order:
        for line, n in dict.fromkeys(split[x]):
            if n:
                holders.setdefault(line, []).append(x)
    out = {}
    for x in order:
        firsts = {holders[line][0] for line, n in split[x] if n and len(holders[line]) > 1 and (len(holders[line]) <= 20 or n >= 15)}
        gone = set()
        for first in firsts - {x}:
            ids = {line: k for k, line in enumerate({a for a, n in [*split[first], *split[x]] if n})}
            code = lambda rows: [ids[a] + 1 if n else 0 for a, n in rows]
            gone |= set(line_dedup.common_blocks(code(split[first]), code(split[x]), [n for _, n in split[x]]))
        out[x] = gone
    return out


def test_lines_of_earlier_documents_go(hard, empty, texts):
    gone = lines_by_hand(texts)
    want = []
    for i, t in texts:
        own = gone[(i is None, i or 0, t)] if t is not None else set()
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in own)
        want.append((i, len(t.split("\n")) if t else 0, len(own), left))
    rows = line_dedup.dedup_lines(hard).collect()
    assert multiset((r.doc_id, r.n_lines, r.n_removed, r.text) for r in rows) == multiset(want)
    assert sum(w[2] for w in want) >= 20
    kept = line_dedup.keep_texts(hard)
    assert kept.columns == hard.columns
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.keep_texts(empty).count() == 0


def test_a_hot_line_pairs_with_its_first_holder_only(spark):
    rows = [(k, f"{'hot line that very many documents have and that is long enough to count here ok'}\nown {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[0] == rows[0][1]
    assert all(got[k] == f"own {k}" for k in range(1, 300))


def test_a_verse_of_short_lines_goes_however_many_have_it(spark):
    verse = "\n".join(f"line {k} of the same short verse" for k in range(9))
    rows = [(k, f"own {k}\n{verse}\nrest {k}") for k in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {0: rows[0][1]} | {k: f"own {k}\nrest {k}" for k in range(1, 25)}


def common_lines(earlier, later):
    """Places in later of lines in runs of 15 words that earlier has too: all starts, all pairs of places."""
    gone = set()
    for i in range(len(earlier)):
        for j in range(len(later)):
            k = 0
            while i + k < len(earlier) and j + k < len(later) and earlier[i + k] == later[j + k]:
                k += 1
            if sum(len(x.split()) for x in later[j : j + k]) >= 15:
                gone |= set(range(j, j + k))
    return gone


def all_pairs(texts):
    split = [[x.strip() for x in t.split("\n")] for t in texts]
    return [set().union(*(common_lines(a, b) for a in split[:n])) for n, b in enumerate(split)]


def test_common_blocks_of_all_pairs_go(spark):
    rng = np.random.default_rng(3)
    p, q, r = (f"{x} has ten words in it and no more of them" for x in ("one", "two", "three"))
    texts = [f"a\n{x}\nb" for x in (p, q, r)] + [f"{x}\n{p}\n{q}\n{r}\n{x}" for x in "cd"]
    texts += [f"{p}\n{q}\nx\n{r}\n{r}", f"{r}\n{r}\nx\n{p}\n{q}", f"{p}\n{q}\nx\n{r}\n{r}\n\n \n"]
    stock = [" ".join([f"w{k}"] * n) for k, n in enumerate((0, 0, 1, 3, 5, 7, 8, 9, 14, 15, 20))]
    texts += ["\n".join(stock[k] for k in rng.integers(0, len(stock), rng.integers(0, 9))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "doc_id long, text string")
    own = sorted((r.doc_id, r.text) for r in df.collect())
    want = ["\n".join(x for y, x in enumerate(t.split("\n")) if y not in gone) for (_, t), gone in zip(own, all_pairs([t for _, t in own]))]
    got = [r.text for r in line_dedup.dedup_lines(df).orderBy("doc_id").collect()]
    assert got == want
    assert sum(a != t for a, (_, t) in zip(got, own)) > 50


def test_blocks_in_another_order_go():
    p, q = [1, 2], [3, 4]
    assert line_dedup.common_blocks([*q, *p], [*p, *q], [8] * 4) == [0, 1, 2, 3]
    assert line_dedup.common_blocks([*q, 0, 1], [*p, *q], [8] * 4) == [2, 3]
    assert line_dedup.common_blocks([2, 1, 4, 3], [*p, *q], [8] * 4) == []


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup])
def test_rows_that_repeat_a_document_do_not_add_to_its_lists(spark, operator):
    rng = np.random.default_rng(9)
    some = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    passage = some(120)
    rows = [(None, f"{some(60)} {passage} {some(60)}")] * 40 + [(1, f"{some(60)} {passage} {some(60)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = []

    class Seen(Written):
        def __call__(self, df, name):
            out = super().__call__(df, name)
            if name == "wanted":
                asked.extend(out.collect())
            return out

    arguments = (substring_dedup.WINDOW, substring_dedup.ROUNDS) if operator is substring_dedup else (suffix_dedup.WINDOW, suffix_dedup.KINDS, suffix_dedup.BUCKET_BYTES)
    found = operator.removed_spans(df, Seen(spark, "t"), "text", "doc_id", *arguments).collect()
    assert len(found) == 2 and len(asked) == 2
    for lists in ([r.spans for r in found], [r.wanted for r in asked]):
        assert all(len(x) == len(set(x)) > 0 for x in lists)
