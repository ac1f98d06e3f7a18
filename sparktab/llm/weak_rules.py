"""Quality rules as weak supervision, in DataFrame functions alone.

Each rule votes good (1) or bad (-1) on a document or abstains (0). Documents are counted
by their pattern of votes, which are few whatever the corpus holds, and
expectation-maximisation over these counts estimates how often documents are good and how
each rule votes on good and on bad ones. A document is kept if its posterior
probability of being good is at least a half, instead of passing every rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import SPACE
from sparktab.session import settled

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_exclaim", "n_letters", "n_marked", "n_bars", "n_lines", "n_distinct")


def _measured(docs: DataFrame) -> DataFrame:
    """Adds the counts of whole texts, NULL as the empty text.

    Each step is a projection of its own, so that the word array is made once. Repeated
    windows: the windows' 64-bit hashes are packed with their places (the low bits) into
    longs and sorted, equal neighbours are checked by their whole hashes, and the
    places found are added up to the words that they cover.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(whole, F.lit(SPACE))
    nothing = F.array().cast("array<string>")
    step = docs.withColumn("__trim", trimmed)
    step = step.withColumn("__words", F.when(F.col("__trim") == "", nothing).otherwise(F.split("__trim", "[\\x20\\x09-\\x0D]+")))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    step = step.withColumns({"n_words": F.size("__words").cast("long"), "__joined": F.array_join("__words", ""), "__lines": lines})
    bare = F.col("__joined")
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    n = F.col("n_words")
    windows = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 3),
        lambda i: F.xxhash64(F.get("__words", i.cast("int")), F.get("__words", (i + 1).cast("int")), F.get("__words", (i + 2).cast("int"))),
    )
    step = step.withColumns(
        {
            "word_chars": F.length("__joined").cast("long"),
            "n_symbols": (F.length("__joined") - F.length(bare)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_upper": F.length(F.regexp_replace("__joined", "[^A-Z\\p{Lu}]+", F.lit(""))).cast("long"),
            "n_exclaim": (F.length("__joined") - F.length(F.replace("__joined", F.lit("!"), F.lit("")))).cast("long"),
            "n_bars": (F.length("__joined") - F.length(F.replace("__joined", F.lit("|"), F.lit("")))).cast("long"),
            "n_letters": F.length(F.regexp_replace("__joined", "[^\\p{L}]+", F.lit(""))).cast("long"),
            "n_marked": F.regexp_count("__trim", F.lit("[#*$%&|<>!]{2}(?![^\\x20\\x09-\\x0D])")).cast("long"),
            "n_distinct": F.size(F.array_distinct("__words")).cast("long"),
            "__hashes": F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")),
            "__low": (F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.ceil(F.log2(n + 1)), F.lit(1)).cast("int")) - 1),
        }
    ).drop("__words", "__joined", "__lines", "__trim")
    low = F.col("__low")
    packed = F.transform("__hashes", lambda h, i: h.bitwiseAND(-1 - low).bitwiseOR(i.cast("long")))
    step = step.withColumn("__sorted", F.sort_array(packed))

    def same(x: Column, y: Column) -> Column:
        high = -1 - low
        at = lambda z: F.get("__hashes", z.bitwiseAND(low).cast("int"))
        return (x.bitwiseAND(high) == y.bitwiseAND(high)) & (at(x) == at(y))

    again = F.filter("__sorted", lambda x, i: F.coalesce(same(x, F.get("__sorted", i + 1)), F.lit(False)) | F.coalesce(same(x, F.get("__sorted", i - 1)), F.lit(False)))
    step = step.withColumn("__again", F.sort_array(F.transform(again, lambda x: x.bitwiseAND(low))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))
    covered = F.aggregate("__again", start, lambda a, x: F.struct((a["n"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
    return step.withColumn("n_repeat_words", covered).drop("__hashes", "__low", "__sorted", "__again")


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, then COUNTS and MORE, all long."""
    renamed = docs.select(*[F.col(c).alias(f"__keep_{c}") for c in keep], "text")
    return _measured(renamed).select(*[F.col(f"__keep_{c}").alias(c) for c in keep], *COUNTS, *MORE)


def per(a: str, b: str) -> Column:
    """A ratio; 0 if the divisor is."""
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def votes() -> dict[str, Column]:
    """The rules: a clear sign of junk is a bad vote, a clear absence a good one."""

    def rule(value: Column, bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    symbols, repeats, length = per("n_symbols", "n_words"), per("n_repeat_words", "n_words"), per("word_chars", "n_words")
    upper, calls, lines = per("n_upper", "word_chars"), per("n_exclaim", "n_words"), per("n_dup_lines", "n_lines")
    variety, letters, marked = per("n_distinct", "n_words"), per("n_letters", "word_chars"), per("n_marked", "n_words")
    bars = per("n_bars", "n_words")
    return {
        "symbols": rule(symbols, symbols > 0.10, symbols < 0.02),
        "letters": rule(letters, letters < 0.80, letters > 0.92),
        "marked_words": rule(marked, marked > 0.10, marked < 0.02),
        "table_bars": rule(bars, bars > 0.08, bars < 0.02),
        "repeated_words": rule(repeats, repeats > 0.30, repeats < 0.10),
        "word_length": rule(length, (length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        "capitals": rule(upper, upper > 0.30, upper < 0.12),
        "exclamations": rule(calls, calls > 0.10, calls < 0.02),
        "repeated_lines": rule(lines, lines > 0.30, (lines < 0.05) & (F.col("n_lines") > 2)),
        "variety": rule(variety, (variety < 0.20) & (F.col("n_words") < 2_000), (variety > 0.45) & (F.col("n_words") >= 100)),
    }


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, list[tuple[float, float]]]:
    """The share of good documents and each rule's (P(good vote | good), P(good vote | bad)) when it votes.

    Bad votes are for clear signs, so it starts from the belief that a document with any is
    rather bad, the more so the more it has. It ends when the share stands still. Counts
    are smoothed by one document per vote and class. An abstention tells nothing. Without
    documents all is even.
    """
    rules = len(patterns[0][0]) if patterns else 0
    belief = [0.95 if -1 not in v else max(0.05, 0.4 - 0.1 * v.count(-1)) for v, _ in patterns]
    share, tables = 0.5, []
    for _ in range(rounds):
        good = sum(b * n for b, (_, n) in zip(belief, patterns))
        before, share = share, (good + 1) / (sum(n for _, n in patterns) + 2)
        tables = []
        for r in range(rules):
            seen = [[1.0, 1.0], [1.0, 1.0]]  # by class, then by vote
            for b, (v, n) in zip(belief, patterns):
                if v[r]:
                    seen[0][v[r] < 0] += b * n
                    seen[1][v[r] < 0] += (1 - b) * n
            tables.append((seen[0][0] / sum(seen[0]), seen[1][0] / sum(seen[1])))
        odds = [math.log(share / (1 - share)) + sum(weight(t, x) for t, x in zip(tables, v)) for v, _ in patterns]
        belief = [1 / (1 + math.exp(-min(max(o, -500), 500))) for o in odds]
        if abs(share - before) < 1e-10:
            break
    return share, tables


def weight(table: tuple[float, float], vote: int) -> float:
    """What a vote adds to the log-odds of good."""
    good, bad = table
    return 0.0 if vote == 0 else math.log(good / bad) if vote > 0 else math.log((1 - good) / (1 - bad))


def judged(counts: DataFrame) -> DataFrame:
    """Adds ``posterior`` (double) to rows with COUNTS and MORE. ``counts`` is read twice: write it first."""
    rules = votes()
    marked = counts.withColumns({f"__vote_{k}": v for k, v in rules.items()})
    names = [f"__vote_{k}" for k in rules]
    found = marked.groupBy(*names).count().orderBy(*names).collect()  # three votes a rule: at most 3 ** rules rows
    share, tables = expectation_maximisation([(tuple(r[c] for c in names), r["count"]) for r in found])
    odds = F.lit(math.log(share / (1 - share)))
    for name, table in zip(names, tables):
        odds = odds + F.when(F.col(name) > 0, weight(table, 1)).when(F.col(name) < 0, weight(table, -1)).otherwise(0.0)
    return marked.withColumn("posterior", 1 / (1 + F.exp(-odds))).drop(*names)


def rule_table(docs: DataFrame, keep: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, kept and posterior of every document.

    NULL and empty texts have no words, so they fail the base rules. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    counts = settled(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]), "counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = judged(counts).withColumn("base_failed", failed)
    return found.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("posterior") >= keep)).alias("kept"), "posterior")
