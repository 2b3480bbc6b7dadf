"""Quality rules: a table of thresholds compiled into Spark projections, without Python.

Each rule bounds one measure of a text.  The measures are plain columns; the compiled rules
stand in a single projection over them, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import BLANKS, squeeze

SYMBOLS = "[#*$%&|<>]"
# Frequent words of English, German, Spanish and French.
STOP_WORDS = (
    "the be to of and that have with a in is it for was as are this by from or "
    "der die das und ist von zu den mit ein eine nicht im dem des auf als auch sich "
    "el la los las de que y en un una por con para es su se no "
    "le les et des du est dans qui pour pas sur au une avec ce"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes when `low` <= `top` / `bottom` <= `high`; a bound of None does not apply."""

    name: str
    top: str
    bottom: str = "1"
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        """Compared as products, so that a zero below the line needs no case of its own."""
        top, bottom = F.expr(self.top).cast("double"), F.expr(self.bottom).cast("double")
        test = F.lit(True)
        if self.low is not None:
            test = test & (top >= bottom * self.low)
        if self.high is not None:
            test = test & (top <= bottom * self.high)
        return test


RULES = (
    Rule("length", "n_words", low=50, high=100_000),
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("letters", "n_letters", "word_chars", low=0.6),
    Rule("capitals", "n_capitals", "n_letters", high=0.4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.3),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.3),
)


def _counted(text: Column, pattern: str) -> Column:
    """Characters of the class `pattern`, counted by what is left without them."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measure(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`carry` and the measures of every text, all long: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_letters, n_capitals,
    n_bullet_lines, n_cut_lines.

    n_repeat_words counts the words that lie in a 3-word window found at least twice in the
    text.  Lines are split at \\n and count when they hold a word.  NULL is an empty text, for
    which every measure is 0; texts below three words have no window.
    """
    blank = "".join(f"\\x{ord(c):02X}" for c in BLANKS)
    split = docs.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn("_s", squeeze(F.col("_t")))
    split = split.select(
        *carry, "_t", "_s",
        F.when(F.col("_s") == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.btrim("_t", F.lit(BLANKS)), f"[{blank}]+")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: squeeze(line) != "").alias("_l"),
    )
    window = lambda i: F.concat_ws(" ", F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    split = split.withColumn(
        "_g", F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), window))
    )
    # Windows found twice lie side by side once sorted; texts without any skip the sort.
    split = split.withColumn("_o", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ))
    same = lambda x, i: F.coalesce(F.get("_o", i)["g"] == x["g"], F.lit(False))
    twice = F.filter("_o", lambda x, i: same(x, i - 1) | same(x, i + 1))
    words = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    lines = lambda pattern: F.size(F.filter("_l", lambda line: line.rlike(pattern)))
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length("_s"),
        "n_symbols": _counted(F.col("_s"), SYMBOLS + "+"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.when(F.col("_o").isNull(), 0).otherwise(F.size(words)),
        "n_lines": F.size("_l"),
        "n_stop_words": F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_letters": _counted(F.col("_s"), r"\p{L}+"),
        "n_capitals": _counted(F.col("_s"), r"\p{Lu}+"),
        "n_bullet_lines": lines(r"^[ \t]*[-*\x{2022}]"),
        "n_cut_lines": lines(r"(\.\.\.|\x{2026})[ \t\r]*$"),
    }
    return split.select(*carry, *[c.cast("long").alias(name) for name, c in counts.items()])


def judge(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """`measure` with base_failed (under 50 words, or more than half of them repeated), failed
    (the names of the rules a text does not pass) and kept.

    Defined cases: NULL and empty texts have no words, fail the base and are not kept;
    repeated rows get equal verdicts; an empty table gives no rows; only `text` and `carry`
    are read, so further columns may have any name.
    """
    measured = measure(docs, text, carry)
    base_failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    failed = F.filter(
        F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules]) if rules else F.array().cast("array<string>"),
        lambda name: name.isNotNull(),
    )
    return measured.select("*", base_failed.alias("base_failed"), failed.alias("failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )
