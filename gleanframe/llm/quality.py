"""Quality rules: a threshold table compiled into one projection without functions of our own.

Each rule is a ratio of two measures that must lie within bounds; the whole table is one
Spark expression over columns measured once per text, so the job is a single narrow stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import SPACES, let, positions, words

NOT_SYMBOLS = "[^#*$%&|<>]+"
#: Common words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it was for on are as with be at by this from or an not "
    "le la les de des et en un une du est que qui dans pour pas sur au avec il elle "
    "der die das und den von zu mit sich auf ist im dem nicht ein eine als auch es "
    "el los las y del se con por para su no lo como al"
).split()
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Keep while ``low * over <= 1000 * part <= high * over`` (per mille; None: unbounded)."""

    name: str
    part: str
    over: str
    low: int | None = None
    high: int | None = None


#: The threshold table.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2000, 15000),
    Rule("symbols", "n_symbols", "n_words", None, 300),
    Rule("stop_words", "n_stop_words", "n_words", 30, None),
    Rule("duplicate_lines", "n_dup_lines", "n_text_lines", None, 400),
    Rule("bullet_lines", "n_bullet_lines", "n_text_lines", None, 900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_text_lines", None, 300),
)


def _repeat_words(w: Column) -> Column:
    """Words inside a 3-word window that the text holds twice or more.

    Window hashes are sorted as plain longs; only windows that may repeat (by a 64-bit mask
    of the repeated hashes) are then sorted again together with their places.
    """
    hashes = F.transform(positions(0, F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(s: Column) -> Column:
        same = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        starts = F.transform(F.filter(s, same), lambda x: F.sequence(x["at"], x["at"] + 2))
        return F.size(F.array_distinct(F.flatten(starts)))

    def bit(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))

    def maybe(h: Column, mask: Column) -> Column:
        at = F.filter(positions(0, F.size(h) - 1), lambda i: bit(F.get(h, i)).bitwiseAND(mask) != 0)
        return F.sort_array(F.transform(at, lambda i: F.struct(F.get(h, i).alias("h"), i.alias("at"))))

    def mask(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.get(s, k - 1) == x)
        return F.aggregate(twice, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(bit(x)))

    return let(hashes, lambda h: let(let(F.sort_array(h), mask), lambda m: let(maybe(h, m), covered)))


def measures(text: Column) -> Column:
    """A struct with every measure of a text (null: empty), all longs."""
    text = F.coalesce(text, F.lit(""))
    n = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def of(w: Column, x: Column) -> Column:
        return F.struct(
            n(F.size(w)).alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, v: a + F.char_length(v)).alias("word_chars"),
            n(F.char_length(F.regexp_replace(text, NOT_SYMBOLS, ""))).alias("n_symbols"),
            n(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            n(_repeat_words(w)).alias("n_repeat_words"),
            n(F.size(F.filter(w, lambda v: v.isin([f(s) for s in STOP_WORDS for f in (str, str.capitalize)])))).alias(
                "n_stop_words"
            ),
            n(F.size(x)).alias("n_text_lines"),
            n(F.size(F.filter(x, lambda v: F.ltrim(v).substr(1, 1).isin("-", "*", "•")))).alias("n_bullet_lines"),
            n(F.size(F.filter(x, lambda v: F.rtrim(v).endswith("...") | F.rtrim(v).endswith("…")))).alias(
                "n_ellipsis_lines"
            ),
        )

    return let(words(text), lambda w: let(lines, lambda x: of(w, x)))


def _holds(rule: Rule, m: Column) -> Column:
    part, over = m[rule.part] * 1000, m[rule.over]
    test = F.lit(True)
    if rule.low is not None:
        test = test & (part >= over * rule.low)
    if rule.high is not None:
        test = test & (part <= over * rule.high)
    return test


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict of every row of ``docs``; other columns are left out.

    Null and empty texts have all measures 0, fail the base rule (fewer than 50 words) and
    are not kept. Repeated rows and null ids are judged one by one. An empty table gives an
    empty result. ``failed`` lists the rules of the table that a text breaks.
    """
    measured = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    m = F.col("m")
    base = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
    failed = F.array_compact(F.array(*[F.when(~_holds(r, m), F.lit(r.name)) for r in RULES]))
    return measured.select("doc_id", "m.*", base.alias("base_failed"), failed.alias("failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )
