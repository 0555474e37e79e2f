"""URL filter: a tree of path templates per host, judged by rules and labelled purity."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stash
from .rows import pack, unpack

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or null; of equal ones blocking wins."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def shape(segment: Column) -> Column:
    """A segment with its variable parts as wildcards: long hexadecimal runs, then digits."""
    hexed = F.regexp_replace(segment, r"(?i)(?=[0-9a-f]*[0-9])[0-9a-f]{8,}(-[0-9a-f]{4,})*", "{hex}")
    return F.regexp_replace(hexed, "[0-9]+", "{n}")


def _compatible(x: Column, n: Column, y: Column, m: Column, alpha: float) -> Column:
    """Hoeffding bound: x of n and y of m may come from one rate."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    wide = bound * (1 / F.sqrt(n) + 1 / F.sqrt(m))
    return F.when((n > 0) & (m > 0), F.abs(x / n - y / m) <= wide).otherwise(F.lit(False))


def _alike(own: Column, both: Column, all_: Column, n: Column, m: Column, alpha: float) -> Column:
    """Whether n pages below one child and m below its siblings may have one distribution.

    own, all_: sums of squared counts of the child and of the node over what follows, both: sum of their products.
    The distance of the two distributions is bounded as McDiarmid's inequality does for n and m draws.
    """
    squared = own / (n * n) - 2 * (both - own) / (n * m) + (all_ - 2 * both + own) / (m * m)
    wide = (1 + math.sqrt(0.5 * math.log(2 / alpha))) * (1 / F.sqrt(n) + 1 / F.sqrt(m))
    return F.when(m > 0, F.sqrt(F.greatest(squared, F.lit(0.0))) <= wide).otherwise(F.lit(False))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    url: str = "url",
    label: Column | None = None,
    many_children: int = 8,
    rare: float = 0.05,
    alpha: float = 0.05,
    smoothing: float = 4.0,
    purity: float = 0.5,
    agreeing: int = 3,
) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity``.

    A page's label is blocked (1), allowed (0) or unknown (null): that of ``label``, or else of the
    longest rule that fits.  Paths are cut at slashes, empty segments left out.  The tree is grown fork by
    fork for all hosts at once, on distinct (host, shaped path) with counts, to the end of every path.  What
    lies between two forks is one chain, which is taken in one round: there are as many rounds as
    forks on one path, however long it is.

    - digits and long hexadecimal runs in a segment are wildcards,
    - of a node with ``many_children`` or more, children with under ``rare`` of its pages are
      one wildcard,
    - siblings are merged into one if what follows below them (the next segment and the depth) is distributed
      as below the other siblings, by a bound at ``alpha``.  Labelled ones must be blocked as often as
      the other labelled ones, too, by a Hoeffding test.  Unlabelled ones have no rate to test: they join
      labelled ones only where ``agreeing`` of these have been merged, since one labelled branch does not
      tell whether its label holds for its neighbours.

    A template's purity is blocked / (labelled + ``smoothing``), and it is rejected from ``purity`` on;
    without labels it is kept.  A rule that fits overrides the template.

    A null url, or one without ``://``, has an empty host and path, and so an empty template.  Repeated
    rows are judged alike.  Added columns take the place of columns of the same name.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pack(pages, host=F.coalesce(host, F.lit("")), path=F.coalesce(path, F.lit("")), _label=label if label is not None else F.lit(None))
    rule, said = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_said": said})
    marked = F.when(F.col("_said") == "block", 1).when(F.col("_said") == "allow", 0)
    shaped = F.filter(F.split("path", "/"), lambda s: s != "")
    shaped = F.transform(shaped, shape)
    rows = rows.withColumns({"_label": F.coalesce(F.col("_label").cast("int"), marked), "_shape": F.array_join(shaped, "/")})
    counts = rows.groupBy("host", "_shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("_label").alias("labelled"), F.coalesce(F.sum("_label"), F.lit(0)).alias("blocked")
    )
    empty = F.array().cast("array<string>")
    tree = counts.withColumns({"_rest": F.when(F.col("_shape") == "", empty).otherwise(F.split("_shape", "/")), "_node": F.lit("")})
    parts = [stash(tree, "url-tree")]
    while not (open_ := parts[-1].where(F.size("_rest") > 0)).isEmpty():
        parts[-1] = parts[-1].where(F.size("_rest") == 0)
        parts.append(stash(_grow(open_, many_children, rare, alpha, agreeing), "url-tree"))
    tree = reduce(DataFrame.unionByName, parts)
    pure = F.col("blocked") / (F.col("labelled") + smoothing)
    templates = tree.groupBy("host", "_node").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    templates = templates.select("host", "_node", pure.alias("purity"))
    of_shape = tree.select("host", "_shape", "_node").join(templates, ["host", "_node"])
    of_shape = of_shape.withColumnRenamed("_node", "template")
    out = rows.join(stash(of_shape, "url-templates"), ["host", "_shape"])
    by_template = F.when(F.col("purity") >= purity, "block").otherwise("allow")
    out = out.withColumn("verdict", F.coalesce("_said", by_template))
    return unpack(out, ["host", "path", "rule", "verdict", "template", "purity"])


def _path(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), "")


def _grow(tree: DataFrame, many: int, rare: float, alpha: float, agreeing: int) -> DataFrame:
    """Move each node's rows down to its first fork and into the children there, or to their ends before."""
    c = F.col
    # if two rows part somewhere, one of them parts from the greatest there or before
    last = tree.groupBy("host", "_node").agg(F.max("_rest").alias("_last"))
    parts = F.array_position(F.zip_with("_rest", "_last", lambda x, y: x == y), F.lit(False))
    rows = tree.join(last, ["host", "_node"]).withColumn("_parts", parts).drop("_last")
    forks = rows.where("_parts > 0").groupBy("host", "_node").agg((F.min("_parts") - 1).cast("int").alias("_fork"))
    rows = stash(rows.drop("_parts").join(forks, ["host", "_node"], "left"), "url-forks")
    goes_on = F.coalesce(F.size("_rest") > c("_fork"), F.lit(False))
    ended = rows.where(~goes_on).withColumns({"_node": F.concat("_node", _path(c("_rest"))), "_rest": F.array().cast("array<string>")})
    open_ = rows.where(goes_on).withColumns(
        {
            "_node": F.concat("_node", _path(F.slice("_rest", 1, c("_fork")))),
            "_child": F.get("_rest", c("_fork")),
            "_rest": F.slice("_rest", c("_fork") + 2, F.size("_rest")),
        }
    )
    node, child = ["host", "_node"], ["host", "_node", "_child"]
    # what follows below a child, as counts; an end is a symbol of its own
    symbol = F.struct(F.get("_rest", F.lit(0)).alias("next"), F.size("_rest").alias("depth")).alias("_next")
    follows = stash(open_.groupBy(*child, symbol).agg(F.sum("n").alias("sn")), "url-follows")
    pooled = stash(follows.groupBy(*node, "_next").agg(F.sum("sn").alias("ps")), "url-follows")
    own, pool = c("sn").cast("double"), c("ps").cast("double")
    sums = follows.join(pooled, [*node, "_next"]).groupBy(*child)
    sums = sums.agg(F.sum(own * own).alias("own"), F.sum(own * pool).alias("both"))
    squares = pooled.groupBy(*node).agg(F.sum(pool * pool).alias("all"))
    children = open_.groupBy(*child).agg(F.sum("n").alias("cn"), F.sum("labelled").alias("cl"), F.sum("blocked").alias("cb"))
    pools = children.groupBy(*node).agg(
        F.sum("cn").alias("pn"), F.sum("cl").alias("pl"), F.sum("cb").alias("pb"), F.count(F.lit(1)).alias("pk")
    )
    named = children.join(sums, child).join(pools.join(squares, node), node)
    alone = c("pl") == c("cl")  # no other labelled sibling
    same_rate = alone | _compatible(c("cb"), c("cl"), c("pb") - c("cb"), c("pl") - c("cl"), alpha)
    alike = _alike(c("own"), c("both"), c("all"), c("cn"), c("pn") - c("cn"), alpha)
    named = stash(named.select(*child, "cn", "cl", "pn", "pl", "pk", (alike & ((c("cl") == 0) | same_rate)).alias("similar")), "url-children")
    witnesses = named.groupBy(*node).agg(F.count_if(c("similar") & (c("cl") > 0)).alias("_agree"))
    named = named.join(witnesses, node)
    variable = (c("pk") >= many) & (c("cn") < rare * c("pn"))
    joins = c("similar") & ((c("cl") > 0) | (c("pl") == 0) | (c("_agree") >= agreeing))
    token = F.when(variable, "*").when(joins, "+")
    named = named.select(*child, F.coalesce(token, c("_child")).alias("_token"))
    grown = open_.join(named, ["host", "_node", "_child"]).withColumn("_node", F.concat("_node", F.lit("/"), "_token"))
    return ended.unionByName(grown.select(ended.columns)).select(tree.columns)
