"""Quality rules as a ledger of bits.

``ledger`` evaluates every rule once and stores the measurements and one bit per failed
rule.  Policies are versioned masks over these bits, so that changing a policy, or asking
what a rule costs, reads the small ledger and never the texts again.

Defined results: a null or empty text has no words and fails ``few_words``; repeated rows
are judged alike; an empty table gives an empty ledger.  Columns of the input that have
the name of a ledger column are replaced, all others are kept.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import bounded_batches, free_name, texts_of

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\f\r"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))

MEASURES = (
    "n_words",  # runs of anything but ASCII white space
    "word_chars",  # code points in them
    "n_symbols",
    "n_lines",  # lines with a word
    "n_dup_lines",  # of these, equal to an earlier line
    "n_repeat_words",  # words in 3-word windows that the text has twice or more
    "n_upper",  # A-Z
    "n_letters",  # A-Z and a-z
)

# A rule's place is its bit, for good: new rules go at the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "n_symbols > n_words",
    "shouting": "n_letters > 0 and 10 * n_upper > 8 * n_letters",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}

POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "shouting"),
    "strict": tuple(RULES),
}


def measure_text(text: bytes) -> tuple[int, ...]:
    """The measurements of one text in UTF-8, in the order of ``MEASURES``."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    word_chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    n_symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    covered = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = set(windows)
        if len(seen) < n - 2:
            once: set = set()
            twice: set = set()
            for w in windows:
                (twice if w in once else once).add(w)
            end = 0  # first word after those counted so far
            for start, w in enumerate(windows):
                if w in twice:
                    covered += start + 3 - max(start, end)
                    end = start + 3
    n_upper = len(joined) - len(joined.translate(None, _UPPER))
    n_lower = len(joined) - len(joined.translate(None, _LOWER))
    dup_lines = len(lines) - len(set(lines))
    return n, word_chars, n_symbols, len(lines), dup_lines, covered, n_upper, n_upper + n_lower


_MEASURED = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])


@F.arrow_udf(_MEASURED)
def measured(texts: pa.Array) -> pa.Array:
    rows = [measure_text(t) for t in texts_of(texts)]
    columns = zip(*rows) if rows else [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for bit, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def ledger(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their measurements and ``failed_bits``."""
    bounded_batches(documents.sparkSession)
    name = free_name(documents, "_measured")
    kept = [c for c in documents.columns if c.lower() not in {*MEASURES, "failed_bits"}]
    rows = documents.withColumn(name, measured(F.col(f"`{text}`").cast("string")))
    return rows.select(*(F.col(f"`{c}`") for c in kept), f"{name}.*").withColumn("failed_bits", failure_bits())


def mask(policy: str | tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in (POLICIES[policy] if isinstance(policy, str) else policy))


def passes(policy: str | tuple[str, ...]) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def apply_policy(documents: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns only."""
    whole = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row")
    rows = ledger(documents.select(whole, F.col(f"`{text}`").alias("_text")), "_text")
    return rows.where(passes(policy)).select("_row.*")


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """What each rule of a policy does: (rule, n_failed, n_only, n_kept_without).

    The ledger shrinks to one row per pattern of bits before anything else, so the rest
    works on 2**rules rows at most.  ``n_only`` are documents that no other rule rejects,
    ``n_kept_without`` those kept if the rule were left out.
    """
    whole = F.lit(mask(policy)).cast("long")
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(whole).alias("bits")).agg(F.count("*").alias("n"))
    names = list(RULES)
    rules = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.lit(1 << names.index(rule)).cast("long").alias("bit"))
            for rule in POLICIES[policy]
        )
    )
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    without = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit).alias("n_failed"),
        total(hit & without).alias("n_only"),
        total(without).alias("n_kept_without"),
    )
