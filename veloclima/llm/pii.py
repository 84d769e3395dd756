"""Personal data by weak supervision.

Four kinds are fixed patterns with a check (``BASE``); their spans always count.  Two more
are open: ``number`` (other long digit groups) and ``secret`` (keys, tokens and the like of 16
characters and more, with two digits and two letters; shorter passwords are not looked for).
Candidates of all kinds are judged by labelers that vote for, against or not at all: the
kind's own pattern, gazetteers of prefixes and endings, words before the span, its shape,
and the share of documents that have it (``COMMON``).  Nobody says which votes are right: expectation
maximisation estimates each labeler's reliability and every pattern of votes gets its
chance of being personal.  A logistic span classifier is then trained on these chances, with
features that need no votes, and decides about the open kinds.

Everything is DataFrame expressions.  Only texts with a digit or an at sign are searched
further.  What the driver gets are counts: of the patterns of votes (3 to the number of
labelers at most) and of the combinations of features (``_FEATURE_VALUES``), whatever the
number of documents.

Patterns run in linear time and constant stack: they begin only where a run of their first
characters begins, or at the end of the match before, and never give characters back.

Defined results: a null or empty text has no spans; rows that repeat doc_id and text get the
same result; an empty table gives an empty result; input columns named like a result column
are replaced.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import Written, free_name, row_identity

KINDS = ("email", "ip", "card", "phone", "number", "secret")
BASE = KINDS[:4]
CHANCE = 0.5
COMMON = 0.005  # share of the documents beyond which a value is nobody's own
_CONTEXT = 32  # code points before a span that labelers may see

# Each after a run's begin or \G, so that no place is tried twice.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?:(?<![A-Za-z0-9])|\G)[0-9](?:[\x20.()/-]?[0-9])++",
    "secret": r"(?:(?<![A-Za-z0-9_=+/-])|\G)(?:[A-Za-z_]{2,24}[=:])?+[A-Za-z0-9_+/-]{16,}+",
}
_SEEN_IN = {
    "email": "text like '%@%'",
    "ip": r"text rlike '[0-9]\\.[0-9]'",
    "card": "text rlike '[0-9][ -]?[0-9]'",
    "phone": "text like '%+%'",
    "number": "text rlike '[0-9][ .()/-]?[0-9]'",
    "secret": "text rlike '[0-9]'",
}

# --- fixed values: gazetteers ----------------------------------------------------------------
_TLDS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|nl|ch|at"
_CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|52|54|55|61|81|82|86|90|91"
_ISSUERS = "3[0-9]|4|5[1-5]|2[2-7]|6"
_KEY_PREFIXES = "AKIA|ASIA|ghp_|gho_|github_pat_|sk-|pk_|xox[abp]-|eyJ|AIza|glpat-"
_SECRET_WORDS = "password|passwd|pwd|passwort|contrasena|secret|token|apikey|api_key|key|auth|bearer|credential|motdepasse"
_CUES = (
    "mail|email|e-mail|correo|courriel|contact|phone|tel|telephone|telefon|call|mobile|fax|card|visa|mastercard|iban|konto|account|"
    "ssn|passport|id|address|ip|host|login|user|" + _SECRET_WORDS
)
_OTHER_CUES = "version|license|licence|page|pages|chapter|section|isbn|issn|doi|year|figure|table|step|line|no|vol|rfc|article"
# ----------------------------------------------------------------------------------------------


def _matches(kind: str) -> Column:
    """Gap lengths, ends of gaps, and matches of a kind, in order; a match may be empty at the end."""
    whole = F.lit(rf"(?s)(.*?)(?:({_PATTERNS[kind]})|\z)")
    gaps, hits = (F.regexp_extract_all("text", whole, F.lit(k)) for k in (1, 2))
    seen = F.struct(
        F.lit(kind).alias("kind"),
        F.transform(gaps, lambda g: F.length(g)).alias("gaps"),
        F.transform(gaps, lambda g: F.right(g, F.lit(_CONTEXT))).alias("before"),
        hits.alias("hits"),
    )
    return F.when(F.expr(_SEEN_IN[kind]), seen)


def _luhn(digits: Column) -> Column:
    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, -k, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(k % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The check of a base kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def candidates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, kind, start, end, value, before, base) of everything that may be personal data."""
    rows = documents.select(row_identity(f"`{doc_id}`", f"`{text}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("text rlike '[0-9@]'")
    found = rows.select("key", F.explode(F.array(*(_matches(k) for k in KINDS))).alias("m")).where("m is not null")
    each = found.select(
        "key", F.col("m.kind").alias("kind"), F.posexplode(F.arrays_zip("m.gaps", "m.before", "m.hits")).alias("n", "x")
    ).dropDuplicates(["key", "kind", "n"])
    order = Window.partitionBy("key", "kind").orderBy("n")
    end = F.sum(F.col("x.gaps") + F.length("x.hits")).over(order)
    each = each.select("key", "kind", end.cast("long").alias("end"), F.col("x.hits").alias("value"), F.col("x.before").alias("before"))
    each = each.where("value <> ''").withColumn("start", F.col("end") - F.length("value"))
    right = F.lit(False)
    for kind in BASE:
        right = F.when(F.col("kind") == kind, valid(kind, F.col("value"))).otherwise(right)
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    letters = F.length(F.regexp_replace("value", "[^A-Za-z]", ""))
    possible = (
        F.when(F.col("kind") == "number", digits >= 7)
        .when(F.col("kind") == "secret", (digits >= 2) & (letters >= 2))
        .otherwise(F.col("kind").isin(*BASE))
    )
    return each.withColumn("base", right).where(possible)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("int")


def votes(found: DataFrame, n_documents: int, common: float = COMMON) -> DataFrame:
    """The candidates with one column per labeler: 1 for, -1 against, 0 no vote.

    A value in more than a share of ``common`` of the documents, and in two, is nobody's own.
    """
    least = 1 + common * n_documents
    common = found.groupBy("kind", "value").agg(F.count_distinct("key").alias("n_docs"))
    common = common.where(F.col("n_docs") > least).select(F.col("kind").alias("_kind"), F.col("value").alias("_value"))
    joined = found.join(common, (F.col("kind") == F.col("_kind")) & (F.col("value") == F.col("_value")), "left")
    value, kind = F.col("value"), F.col("kind")
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    length = F.length("value")
    word = F.lower(F.regexp_extract("before", r"([A-Za-z_-]+)[^A-Za-z0-9]{0,3}$", 1))
    own_word = F.lower(F.regexp_extract("value", r"^([A-Za-z_]+)[=:]", 1))
    pattern = (
        F.when(kind.isin(*BASE), F.when(F.col("base"), 1).otherwise(-1))
        .when(kind == "number", _vote(value.rlike(r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})$"), value.rlike(r"^[0-9]+$|[./]")))
        .otherwise(_vote(value.rlike(rf"^(?:{_KEY_PREFIXES})|^[A-Za-z_]+[=:]"), value.rlike(r"^[a-z]+(?:-[a-z0-9]+)*$")))
    )
    gazetteer = (
        F.when(kind == "email", _vote(value.rlike(rf"\.(?:{_TLDS})$"), F.lit(False)))
        .when(kind == "ip", _vote(F.lit(False), value.rlike(r"^(?:0|127|255)\.|^1\.[0-9]\.")))
        .when(kind == "card", _vote(value.rlike(rf"^(?:{_ISSUERS})") & digits.between(13, 19), ~value.rlike(rf"^(?:{_ISSUERS})")))
        .when(kind == "phone", _vote(value.rlike(rf"^\+(?:{_CALLING_CODES})"), F.lit(False)))
        .when(kind == "number", _vote(value.rlike(rf"^(?:00(?:{_CALLING_CODES})|0[1-9])"), value.rlike(r"^(?:19|20)[0-9]{2}[ ./-]")))
        .otherwise(_vote(value.rlike(rf"^(?:{_KEY_PREFIXES})") | own_word.rlike(rf"(?:{_SECRET_WORDS})"), F.lit(False)))
    )
    context = _vote(word.rlike(rf"^(?:{_CUES})$"), word.rlike(rf"^(?:{_OTHER_CUES})$"))
    shape = (
        F.when(kind == "secret", _vote((digits >= 3) & (length >= 18), (digits < 3) | value.rlike("^[0-9/_-]+$")))
        .when(kind == "number", _vote(digits.between(9, 12) & value.rlike("[ ()-]"), (digits > 12) | (digits < 9)))
        .when(kind == "card", _vote(digits.between(15, 16), (digits < 13) | (digits > 19)))
        .otherwise(_vote(length.between(7, 60), length > 100))
    )
    frequency = _vote(F.lit(False), F.col("_value").isNotNull())
    return joined.select(*found.columns, *(v.alias(f"vote_{n}") for n, v in zip(LABELERS, (pattern, gazetteer, context, shape, frequency))))


LABELERS = ("pattern", "gazetteer", "context", "shape", "frequency")


class Reliability:
    """A two-class model of independent labelers, estimated by expectation maximisation."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200):
        votes = np.array([p for p, _ in patterns], int).reshape(len(patterns), -1)
        n = np.array([c for _, c in patterns], float)
        self.patterns = [p for p, _ in patterns]
        chance = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1)))  # begin with the majority
        for _ in range(rounds):
            self.prior = float((n * chance).sum() + 1) / float(n.sum() + 2)
            weights = n * chance, n * (1 - chance)
            # of each labeler and class: the shares of votes -1, 0 and 1, smoothed
            self.tables = [
                np.array([[((votes[:, k] == v) * w).sum() + 1 for v in (-1, 0, 1)] for k in range(votes.shape[1])]) for w in weights
            ]
            self.tables = [t / t.sum(axis=1, keepdims=True) for t in self.tables]
            logs = [sum(np.log(t[k][votes[:, k] + 1]) for k in range(votes.shape[1])) for t in self.tables]
            odds = logs[0] - logs[1] + math.log(self.prior / (1 - self.prior))
            after = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            moved = np.abs(after - chance).max(initial=0)
            chance = after
            if moved < 1e-9:
                break
        self.chance = chance


# Features of a span and the number of values of each; none is a vote.
_FEATURE_VALUES = {"kind": 6, "length": 6, "digits": 5, "capitals": 3, "separators": 3, "after_sign": 2, "cue": 3}


def span_features() -> dict[str, Column]:
    length = F.length("value")
    share = lambda chars: F.length(F.regexp_replace("value", f"[^{chars}]", "")) / length
    several = lambda chars: F.least(F.lit(2), F.length(F.regexp_replace("value", f"[^{chars}]", ""))).cast("int")
    kind = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")).cast("int") - 1
    bucket = sum((F.when(length >= k, 1).otherwise(0) for k in (9, 13, 17, 21, 33)), F.lit(0))
    word = F.lower(F.regexp_extract("before", r"([A-Za-z_-]+)[^A-Za-z0-9]{0,3}$", 1))
    return {
        "kind": kind,
        "length": bucket,
        "digits": F.floor(4 * share("0-9")).cast("int"),
        "capitals": F.floor(2 * share("A-Z")).cast("int"),
        "separators": several(r"\x20()./-"),
        "after_sign": F.when(F.col("before").rlike("[=:#]\\s?$") | F.col("value").rlike("[=:]"), 1).otherwise(0),
        "cue": F.when(word.rlike(rf"^(?:{_CUES})$"), 1).when(word.rlike(rf"^(?:{_OTHER_CUES})$"), 2).otherwise(0),
    }


def fit_classifier(rows: list[tuple[tuple[int, ...], float, float]], ridge: float = 1.0) -> dict[str, list[float]]:
    """(feature values, weight, share of positives) -> a weight per value, by Newton steps."""
    sizes = list(_FEATURE_VALUES.values())
    first = np.concatenate([[1], 1 + np.cumsum(sizes)[:-1]])
    x = np.zeros((len(rows), 1 + sum(sizes)))
    x[:, 0] = 1
    for k, (values, _, _) in enumerate(rows):
        x[k, first + np.array(values)] = 1
    n, y = (np.array([r[k] for r in rows], float) for k in (1, 2))
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (y - p)) - ridge * w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    out = {"": [float(w[0])]}
    out.update({name: w[a : a + size].tolist() for name, a, size in zip(_FEATURE_VALUES, first, sizes)})
    return out


def chance_of(weights: dict[str, list[float]]) -> Column:
    total = F.lit(weights[""][0])
    for name, value in span_features().items():
        total = total + F.element_at(F.array(*(F.lit(w) for w in weights[name])), value + 1)
    return 1 / (1 + F.exp(-total))


def train(voted: DataFrame) -> tuple[Reliability | None, dict[str, list[float]]]:
    """Labeler reliabilities, and the span classifier trained on what follows from them."""
    columns = [f"vote_{n}" for n in LABELERS]
    patterns = {tuple(r[c] for c in columns): r["n"] for r in voted.groupBy(*columns).agg(F.count("*").alias("n")).collect()}
    if not patterns:
        return None, {"": [0.0], **{name: [0.0] * n for name, n in _FEATURE_VALUES.items()}}
    model = Reliability(sorted(patterns.items()))
    known = [(",".join(map(str, p)), float(c)) for p, c in zip(model.patterns, model.chance)]
    table = F.create_map(*(F.lit(x) for pair in known for x in pair))
    chance = F.element_at(table, F.concat_ws(",", *(F.col(c).cast("string") for c in columns)))
    names = list(_FEATURE_VALUES)
    spans = voted.select(*(c.alias(f"f_{n}") for n, c in span_features().items()), chance.alias("chance"))
    sums = spans.groupBy(*(f"f_{n}" for n in names)).agg(F.count("*").alias("n"), F.avg("chance").alias("chance")).collect()
    training = sorted((tuple(r[f"f_{n}"] for n in names), float(r["n"]), r["chance"]) for r in sums)
    return model, fit_classifier(training)


def personal_spans(
    documents: DataFrame, tables: Written, text: str = "text", doc_id: str = "doc_id", common: float = COMMON
) -> DataFrame:
    """(key, kind, start, end, base): all base spans, and added ones that touch none of them."""
    found = tables(candidates(documents, text, doc_id), "candidates")
    voted = tables(votes(found, documents.count(), common), "votes")
    _, weights = train(voted)
    chosen = voted.where(F.col("base") | (~F.col("kind").isin(*BASE) & (chance_of(weights) >= CHANCE)))
    chosen = chosen.withColumn("place", F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")).cast("int"))
    # A later kind gives way to base spans and to earlier added kinds.  Both frames grow row by
    # row, the second from the end, so a document's spans are passed over once each way.
    before = Window.partitionBy("key").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("key").orderBy(F.desc("start"), F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    for place in (5, 6):
        prior = F.col("place") < place
        met = (F.coalesce(F.max(F.when(prior, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (
            F.coalesce(F.min(F.when(prior, F.col("start"))).over(after), F.lit(1 << 60)) < F.col("end")
        )
        chosen = chosen.withColumn("_met", met).where((F.col("place") != place) | ~F.col("_met")).drop("_met")
    return chosen.select("key", "kind", "place", "start", "end", "base")


def find_personal_data(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``personal``, an array of (place, start, end, kind, base) in the order
    of ``KINDS``, then of start."""
    tables = Written(documents.sparkSession, "pii")
    spans = personal_spans(documents, tables, text, doc_id)
    name = free_name(documents, "_key")
    per_row = spans.groupBy(F.col("key").alias(name)).agg(
        F.sort_array(F.collect_list(F.struct("place", "start", "end", "kind", "base"))).alias("personal")
    )
    kept = [c for c in documents.columns if c.lower() != "personal"]
    rows = documents.select(*(F.col(f"`{c}`") for c in kept), row_identity(f"`{doc_id}`", f"`{text}`").alias(name))
    return rows.join(tables(per_row, "spans"), name, "left").drop(name)


def mask(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with each span of their text replaced by its kind in angle brackets."""
    found = find_personal_data(documents, text, doc_id)
    ordered = F.array_sort(F.transform("personal", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    body = F.col(f"`{text}`")

    def cut(a: Column, s: Column) -> Column:
        piece = F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        new = F.struct(F.concat(a["out"], piece, F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= a["at"], new).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    def end(a: Column) -> Column:
        return F.concat(a["out"], F.substring(body, (a["at"] + 1).cast("int"), F.length(body)))

    masked = F.when(F.col("personal").isNull(), body).otherwise(F.aggregate(ordered, state, cut, end))
    return found.withColumn(text, masked).drop("personal")
