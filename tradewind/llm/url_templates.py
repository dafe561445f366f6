"""URL verdicts: fixed rules first, then a tree of path templates for each host."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.util import stored

#: Labels from which a branch is tested against its siblings on the way down, and from which it stays one even if it is like them
#: as a whole, as its own branches may differ.
LEAST, ENOUGH = 5, 20
#: Standard deviations at which two shares differ.
Z = 1.96
#: One labelled page in so many is held out to learn the threshold; shares are told apart in so many steps.
HELD_OUT, STEPS = 5, 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and path up to a query or fragment; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict. A rule such as ``example.org/es/`` holds for a host and all its
    subdomains and for paths that start with its own."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tried first, so it is put on last
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """Runs of digits and long hexadecimal names are variable by their form alone."""
    return F.regexp_replace(F.regexp_replace(segment, r"(?i)\b[0-9a-f]{12,}\b", "{x}"), r"[0-9]+", "{n}")


def _levels(path: Column, depth: int) -> tuple[list[Column], Column]:
    """The first ``depth`` segments of a path, with null below its end, and what is deeper, or null."""
    parts = F.split(F.regexp_replace(path, r"^/", ""), "/")
    rest = F.concat(F.lit("/"), F.array_join(F.slice(parts, depth + 1, F.greatest(F.size(parts), F.lit(1))), "/"))
    return ([F.when((path != "") & (F.size(parts) > d), F.get(parts, F.lit(d))) for d in range(depth)],
            F.when(F.size(parts) > depth, rest))


def _joined(levels: list[Column]) -> Column:
    """A path's segments in one string; only an empty path gives an empty one."""
    return F.when(levels[0].isNull(), "").otherwise(F.concat(F.lit("/"), F.array_join(F.array(*levels), "/")))


def templates(pages: DataFrame, depth: int = 4, z: float = Z) -> DataFrame:
    """Templates of each host: ``host``, ``shape`` (of a page's path), ``template``, ``n``, ``labelled``, ``bad``.

    ``pages`` has ``host``, ``path`` and ``label`` (1 bad, 0 good, null unknown). Equal shapes are summed up first, so
    everything below is about distinct shapes with their counts. Going down from the root, the children of a node become one
    wildcard branch, however many they are, but for those that have ``ENOUGH`` labels, or ``LEAST`` and a share of bad pages that
    differs from that of all children (two-sided test at ``z``). Going up again, a branch whose share doesn't differ from that of its
    siblings together (same test) is merged with them.

    This takes ``depth`` segments at a time. A template that has deeper pages and both good and bad labels is refined by the
    next ones, and so on; where all labels agree, or fewer than ``LEAST`` are deeper, no branch could differ.
    """
    level, counts = [f"_s{d}" for d in range(depth)], ["n", "labelled", "bad"]
    rows = pages.select("host", "label", _shape(F.col("path")).alias("shape"))
    tree = rows.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    tree, settled = tree.withColumns({"_base": F.lit(""), "_rest": F.col("shape")}), []
    while True:
        segments, rest = _levels(F.col("_rest"), depth)
        tree = stored(tree.select("host", "_base", "shape", *[c.alias(x) for c, x in zip(segments, level)],
                                  rest.alias("_rest"), *counts), "url-shapes")
        placed = _placed(tree, level, z)
        mixed = placed.groupBy("host", "template").agg(
            F.sum("labelled").alias("_k"), F.sum("bad").alias("_b"),
            F.sum(F.when(F.col("_rest").isNotNull(), F.col("labelled"))).alias("_below")).where(
            (F.col("_b") > 0) & (F.col("_b") < F.col("_k")) & (F.col("_below") >= LEAST)).select(
            F.col("host").alias("_mh"), F.col("template").alias("_mt"))
        placed = stored(placed.join(mixed, (F.col("host") == F.col("_mh")) & (F.col("template") == F.col("_mt")), "left").select(
            "host", "shape", "template", "_rest", *counts,
            (F.col("_mt").isNotNull() & F.col("_rest").isNotNull()).alias("_deeper")), "url-placed")
        settled.append(placed.where(~F.col("_deeper")).select("host", "shape", "template", *counts))
        deeper = placed.where("_deeper")
        if deeper.isEmpty():
            break
        tree = deeper.select("host", F.col("template").alias("_base"), "shape", "_rest", *counts)
    found = reduce(DataFrame.unionByName, settled)
    totals = found.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in counts])
    return found.select("host", "shape", "template").join(totals, ["host", "template"])


def _same(names: list[str], others: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(names, others)])


def _differs(share: Column, bad: Column, labelled: Column, z: float) -> Column:
    """Whether a branch's bad pages aren't as many as its siblings' share makes likely."""
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-4)) * F.greatest(labelled, F.lit(1)))
    return F.abs(bad - share * labelled) >= z * spread


def _placed(tree: DataFrame, level: list[str], z: float) -> DataFrame:
    """``tree`` with the ``template`` of each shape by the segments in ``level``, below that in ``_base``."""
    root, merged = ["host", "_base"], [f"_m{d}" for d in range(len(level))]
    down = tree
    for d, name in enumerate(level):  # downwards
        parent = [*root, *level[:d]]
        own = down.where(F.col(name).isNotNull()).groupBy(*parent, name).agg(
            F.sum("labelled").alias("_k"), F.sum("bad").alias("_b"))
        wide = own.groupBy(*parent).agg(F.count(F.lit(1)).alias("_kids"), F.sum("_k").alias("_pk"), F.sum("_b").alias("_pb")).where(
            "_kids > 1")
        wide = wide.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent)], "_pk", "_pb", F.lit(True).alias("_wide"))
        above = [f"_p{i}" for i in range(len(parent))]
        share = F.col("_pb") / F.greatest(F.col("_pk"), F.lit(1))
        branch = own.where(F.col("_k") >= LEAST).join(wide, _same(parent, above)).where(
            (F.col("_k") >= ENOUGH) | _differs(share, F.col("_b"), F.col("_k"), z))
        branch = branch.select(*[F.col(c).alias(f"_q{i}") for i, c in enumerate([*parent, name])], F.lit(True).alias("_branch"))
        down = down.join(wide.drop("_pk", "_pb"), _same(parent, above), "left").join(
            branch, _same([*parent, name], [f"_q{i}" for i in range(len(parent) + 1)]), "left")
        down = stored(down.withColumn(name, F.when(
            F.col("_wide") & F.col("_branch").isNull() & F.col(name).isNotNull(), F.lit("*")).otherwise(F.col(name))).select(
            *tree.columns), "url-tree")
    leaf = down.groupBy(*root, *level).agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    leaf = leaf.select(*root, *level, *[F.col(s).alias(m) for s, m in zip(level, merged)], "n", "labelled", "bad")
    for name in reversed(merged):  # upwards
        leaf = stored(_merge_siblings(leaf, [*root, *merged], name, z), "url-merge")
    of = leaf.select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate([*root, *level])],
                     F.concat("_base", _joined([F.col(m) for m in merged])).alias("template"))
    return down.join(of, (F.col("host") == F.col("_l0")) & _same(["_base", *level], [f"_l{i + 1}" for i in range(len(level) + 1)])).select(
        *tree.columns, "template")


def _merge_siblings(leaf: DataFrame, node: list[str], name: str, z: float) -> DataFrame:
    parent = [c for c in node if c != name]
    own = leaf.groupBy(*node).agg(F.sum("labelled").alias("_k"), F.sum("bad").alias("_b"))
    pooled = own.where(F.col(name).isNotNull()).groupBy(*parent).agg(
        F.sum("_k").alias("_pk"), F.sum("_b").alias("_pb"), F.count(F.lit(1)).alias("_kids")).where("_kids > 1")
    share = F.col("_pb") / F.greatest(F.col("_pk"), F.lit(1))
    alike = own.join(pooled.withColumnsRenamed({c: f"_q{i}" for i, c in enumerate(parent)}), reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_q{i}")) for i, c in enumerate(parent)])).where(
        F.col(name).isNotNull() & ~_differs(share, F.col("_b"), F.col("_k"), z))
    alike = alike.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(node)], F.lit(True).alias("_alike"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(node)])
    joined = leaf.join(alike, same, "left")
    return joined.withColumn(name, F.when(F.col("_alike"), F.lit("*")).otherwise(F.col(name))).select(*leaf.columns)


def _shares(rows: DataFrame, strength: float, depth: int, z: float) -> DataFrame:
    """The smoothed share of bad pages of each shape's template: ``_host``, ``_shape``, ``template``, ``bad_share``."""
    found = templates(rows, depth, z)
    hosts = rows.groupBy("host").agg(F.count("label").alias("_hk"), F.coalesce(F.sum("label"), F.lit(0)).alias("_hb"))
    total = hosts.agg(F.sum("_hb").alias("b"), F.sum("_hk").alias("k")).first()
    prior = (total["b"] or 0) / (total["k"] or 1)
    of_host = (F.col("_hb") + strength * prior) / (F.col("_hk") + strength)
    share = (F.col("bad") + strength * of_host) / (F.col("labelled") + strength)
    return found.join(hosts, "host").select(F.col("host").alias("_host"), F.col("shape").alias("_shape"), "template",
                                            share.alias("bad_share"))


def _with_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    shaped = rows.withColumn("_of", _shape(F.col("path")))
    return shaped.join(shares, (F.col("host") == F.col("_host")) & (F.col("_of") == F.col("_shape")), "left")


@dataclass(frozen=True)
class Threshold:
    """The share of bad pages from which a template is rejected, and what it does to held-out labelled pages: pages above and below it,
    and how many of each are bad. Without a threshold nothing is rejected."""

    share: float | None
    blocked: int = 0
    blocked_bad: int = 0
    kept: int = 0
    kept_bad: int = 0


def chosen(counts: list[tuple[int, int, int]], z: float = Z, worth: float = 1.0) -> Threshold:
    """The threshold for held-out pages as (step of the share, pages, bad pages): the one that gains most, where a bad page rejected
    is worth ``worth`` good pages lost, if the pages above it are bad more often than those below by ``z`` standard deviations.
    Of equally good ones the highest. If none gains anything, there is no threshold."""
    pages, bad = sum(n for _, n, _ in counts), sum(b for _, _, b in counts)
    if not 0 < bad < pages:
        return Threshold(None)
    best, gain, above, above_bad = Threshold(None, 0, 0, pages, bad), 0.0, 0, 0
    for step, n, b in sorted(counts, reverse=True):
        above, above_bad = above + n, above_bad + b
        found = worth * above_bad - (above - above_bad)
        if found > gain:
            best, gain = Threshold(step / STEPS, above, above_bad, pages - above, bad - above_bad), found
    if best.share is None or not best.kept:
        return best
    rate = bad / pages
    spread = (rate * (1 - rate) * (1 / best.blocked + 1 / best.kept)) ** 0.5
    sure = best.blocked_bad / best.blocked - best.kept_bad / best.kept >= z * spread
    return best if sure else Threshold(None, 0, 0, pages, bad)


def learn_threshold(rows: DataFrame, strength: float, depth: int, z: float = Z) -> Threshold:
    """``chosen`` for a part of the labelled pages, by templates that are fitted to the others."""
    held = F.col("label").isNotNull() & (F.pmod(F.xxhash64("page_id", "url"), F.lit(HELD_OUT)) == 0)
    fitted = rows.withColumn("label", F.when(~held, F.col("label")))
    # The templates' shapes come from all pages, so every held-out page has one.
    scored = _with_shares(rows.where(held), _shares(fitted, strength, depth, z))
    steps = scored.groupBy(F.floor(F.col("bad_share") * STEPS).cast("int").alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad"))
    return chosen([(r["step"], r["n"], r["bad"]) for r in steps.collect()], z)


def judge(pages: DataFrame, rules: list[tuple[str, str]], threshold: float | None = None, strength: float = 20.0,
          depth: int = 4, z: float = Z) -> DataFrame:
    """Each page with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``bad_share``.

    ``pages`` has ``page_id``, ``url`` and ``label`` (1 bad, 0 good, null unknown; its mean over labelled pages, all of
    them, is the prior); more columns are left out. A rule decides where one fits; else a page is blocked if the smoothed
    share of bad pages in its template is ``threshold`` or more. The share is drawn towards the host's, and the host's towards
    the prior, as if by ``strength`` further pages. Without a ``threshold`` it is learnt from held-out labels (``learn_threshold``);
    where no template turns out bad more often than good, none is rejected. A null url, or one without ``://``, has an empty host and
    path and is judged with the others of that kind; a path of any length is a path, and a page without an id is a page. Repeated rows
    are judged alike; an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", F.col("label").cast("long").alias("label")).withColumns(
        {"host": host, "path": path})
    if threshold is None:
        threshold = learn_threshold(rows, strength, depth, z).share
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    joined = _with_shares(rows, _shares(rows, strength, depth, z))
    rejected = F.lit(False) if threshold is None else F.col("bad_share") >= threshold
    by_method = F.when(rejected, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                         "template", "bad_share")
