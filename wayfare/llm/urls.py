"""URL filter: rules first, then the ratio of two character language models.  DataFrame functions only.

Rules name a host and a path prefix and fit the host's subdomains too; the
longest fitting rule decides.  The URLs that rules allow and block train two
variable-order Markov models over the characters of host and path: Witten-Bell
smoothing blends every order from ``ORDER`` down to none.  A URL without a
rule is blocked if its log-likelihood difference, divided by its length, is
below the threshold that best separates URLs the models haven't seen.

All counts are over all rows; equal URLs are counted once with their number.
Null URLs and those without ``://`` have an empty host and path, and the
models judge the empty string.  Without training URLs of both kinds every URL
without a rule is allowed.  Rows may repeat; other columns pass through, and
columns named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfare.llm.anchors import written

#: Characters before the next one that the longest contexts have.
ORDER = 4

#: Scores are added as whole billionths, so that no order of rows changes a sum.
UNIT = 1_000_000_000

_START, _STOP = "\u0002", "\u0003"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host/path``: the host with its subdomains, and how the path must start."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        cut = self.text.index("/")
        own = self.text[:cut]
        return ((host == own) | host.endswith("." + own)) & path.startswith(self.text[cut:])


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def first_rule(rules: list[Rule], host: Column, path: Column, value: str) -> Column:
    """The text or verdict of the longest rule that fits; null if none does.  Of equally long ones a block wins."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        chosen = F.when(rule.fits(host, path), getattr(rule, value)).otherwise(chosen)
    return chosen


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """Every character of ``_text``, and a stop, behind the ``order`` characters before it."""
    padded = F.concat(F.lit(_START * order), "_text", F.lit(_STOP))
    places = F.sequence(F.lit(1), F.char_length("_text") + 1)
    return texts.withColumn("_padded", padded).withColumn("_at", F.explode(places)).withColumn(
        "gram", F.col("_padded").substr(F.col("_at"), F.lit(order + 1))
    ).drop("_padded", "_at")


def model(training: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """Log of the ratio of both models for each wanted gram.

    ``training`` has ``_text``, ``allow`` and ``block``, how often a URL was
    accepted and rejected; ``wanted`` has distinct ``gram``.
    """
    counts = written(_grams(training, order).groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")),
                     "grams")
    kinds = ("allow", "block")
    letters = counts.agg(F.count_distinct(F.substring("gram", order + 1, 1))).first()[0] + 1
    scored = wanted.select("gram", *(F.lit(1.0 / letters).alias(f"p_{k}") for k in kinds))
    for length in range(order + 1):
        tail = F.substring("gram", order + 1 - length, length + 1)
        seen = counts.groupBy(tail.alias("tail")).agg(*(F.sum(k).alias(f"n_{k}") for k in kinds))
        contexts = seen.groupBy(F.substring("tail", 1, length).alias("context")).agg(
            *(F.sum(f"n_{k}").alias(f"all_{k}") for k in kinds),
            *(F.count(F.when(F.col(f"n_{k}") > 0, 1)).alias(f"kinds_{k}") for k in kinds),
        )
        scored = (
            scored.withColumn("tail", tail).withColumn("context", F.substring("tail", 1, length))
            .join(seen, "tail", "left").join(contexts, "context", "left").drop("tail", "context")
        )
        blended = {
            f"p_{k}": F.when(
                F.col(f"all_{k}") > 0,
                (F.coalesce(f"n_{k}", F.lit(0)) + F.col(f"kinds_{k}") * F.col(f"p_{k}"))
                / (F.col(f"all_{k}") + F.col(f"kinds_{k}")),
            ).otherwise(F.col(f"p_{k}")) for k in kinds
        }
        scored = scored.withColumns(blended).select("gram", *blended)
    ratio = F.round((F.log("p_allow") - F.log("p_block")) * UNIT).cast("long")
    return scored.select("gram", ratio.alias("ratio"))


def scores(texts: DataFrame, training: DataFrame, order: int = ORDER) -> DataFrame:
    """Distinct ``_text`` of the texts, with ``score``: the log ratio in billionths over the number of characters."""
    texts = texts.select("_text").distinct().withColumns({"_a": F.xxhash64("_text"), "_b": F.hash("_text")})
    texts = written(texts, "texts")
    grams = written(_grams(texts, order).select("_a", "_b", "gram"), "places")
    ratios = written(model(training, grams.select("gram").distinct(), order), "ratios")
    summed = grams.join(ratios, "gram").groupBy("_a", "_b").agg(F.sum("ratio").alias("ratio"))
    return texts.join(summed, ["_a", "_b"]).select(
        "_text", (F.col("ratio") / (F.char_length("_text") + 1) / UNIT).alias("score")
    )


def threshold(scored: DataFrame) -> float | None:
    """The hundredth that separates accepted and rejected URLs with the fewest errors of both shares.

    ``scored`` has ``score``, ``allow`` and ``block``.  Scores are counted in
    hundredths between -20 and 20, so a few thousand rows are left to order.
    None if there is only one kind.
    """
    place = F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 100))).cast("int")
    bins = scored.groupBy(place.alias("place")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    below, everywhere = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    kinds = ("allow", "block")
    shares = bins.select("place", *(
        (F.coalesce(F.sum(k).over(below), F.lit(0)) / F.nullif(F.sum(k).over(everywhere), F.lit(0))).alias(k) for k in kinds
    ))
    best = shares.orderBy(F.col("allow") - F.col("block"), "place").first()
    return None if best is None or best["allow"] is None or best["block"] is None else best["place"] / 100


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """URLs to count and URLs to set the threshold by, which the models must not have seen.

    Three of sixteen, by a hash, set the threshold; if a part lacks accepted or
    rejected URLs, all serve for both.
    """
    held = F.ascii(F.substring(F.md5("_text"), 32, 1)) % 5 == 0
    marked = marked.withColumn("_held", held)
    parts_ = marked.groupBy("_held").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).collect()
    if len(parts_) < 2 or not all(p["allow"] and p["block"] for p in parts_):
        return marked.drop("_held"), marked.drop("_held")
    return marked.where(~F.col("_held")).drop("_held"), marked.where("_held").drop("_held")


def judge(pages: DataFrame, rules: list[Rule], *, url: str = "url", order: int = ORDER) -> DataFrame:
    """Pages with ``host``, ``path``, the deciding ``rule`` (null if none), ``score`` (of those) and ``verdict``."""
    added = ["host", "path", "rule", "score", "verdict"]
    own = [c for c in pages.columns if c not in added or c == url]
    pages = pages.select(F.col(f"`{url}`").alias("_url"), F.struct(*(F.col(f"`{c}`") for c in own)).alias("_rest"))
    host, path = parts(F.col("_url"))
    pages = pages.select("_rest", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    by = {name: first_rule(rules, F.col("host"), F.col("path"), field) for name, field in (("rule", "text"), ("_rule", "verdict"))}
    pages = pages.withColumns(by).withColumn("_text", F.concat("host", "path"))

    # The same host and path may be judged by one rule only, so a text has one kind.
    texts = written(
        pages.groupBy("_text", "_rule").agg(F.count("*").alias("n")).select(
            "_text", *(F.when(F.col("_rule") == k, F.col("n")).otherwise(0).alias(k) for k in ("allow", "block"))
        ), "urls")
    marked = texts.where("allow + block > 0")
    training, unseen = split(marked)
    scored = written(scores(texts, training, order), "scores")
    limit = threshold(scored.join(unseen, "_text"))
    scored = scored.withColumn("_guess", F.when(F.col("score") < limit, "block").otherwise("allow")
                               if limit is not None else F.lit("allow"))
    judged = pages.join(scored, "_text", "left").withColumn("verdict", F.coalesce("_rule", "_guess"))
    return judged.select(*(F.col("_rest")[c].alias(c) for c in own), *(c for c in added if c not in own))
