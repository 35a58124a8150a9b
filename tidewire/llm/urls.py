"""URL filter by path templates: per host a tree of path segments, judged by the labelled purity of its leaves.

Segments with digits are variable by form; others are variable where their value is rare at its node of the tree and its
labels do not set it apart from the other rare ones. Nodes are generalised from the root down, each below the generalised
path to it, so what is below a variable segment is one node. Sibling leaves whose purity does not differ from their common
pool are merged, from the deepest segment up. Pages are reduced to counts by host and path form before any tree work, and
only those counts are joined and grouped; a hot host is split over salted keys. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import NO_HOT, Hot, ascii_lower, hot_keys, salted_join, written

#: A value with this many pages and this share of its node's pages stays literal; a rarer one if its labels set it apart.
LITERAL_PAGES, LITERAL_SHARE = 20, 0.01
#: Leaves within this many standard deviations of their pool are merged; pseudo-counts at the prior; least purity.
SIMILAR, SMOOTHING, PURITY = 1.96, 10.0, 0.5
#: Chance at which the rarer values of a node are told apart, all of them together.
CHANCE = 0.05
#: Segments with a digit, and others that vary; WORDS where a node has both kinds and their purity differs.
ANY, WORDS = "*", "*words"
#: A node of the tree: its host and the generalised path to it.
NODE = ["_host", "_leaf"]


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; rules are (host, path, verdict)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for owner, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == owner) | host.endswith("." + owner)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(owner + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def path_form(path: Column) -> Column:
    """Segments of a path, those with a digit as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), ANY).otherwise(s))


def _apart(good: Column, bad: Column, share: Column, tests: Column) -> Column:
    """Whether labels differ from a pool with ``share`` good ones more than chance allows in so many tests.

    Chernoff's bound on the binomial tail, so it holds for small counts: one label alone is never apart from its pool.
    """
    seen = good + bad

    def part(n: Column, p: Column) -> Column:
        return F.when(n > 0, n * F.log(n / (seen * p))).otherwise(0.0)

    return part(good, share) + part(bad, 1 - share) > F.log(2 * tests / CHANCE)


def _share(good: Column, bad: Column) -> Column:
    return (good + 1) / (good + bad + 2)


def _hot(rows: DataFrame, keys: list[str], skewed: bool) -> Hot:
    """Keys that hold many rows; without a host that does there is none."""
    return hot_keys(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), keys, "_rows") if skewed else NO_HOT


def _to_branch(forms: DataFrame, skewed: bool) -> DataFrame:
    """``forms`` (_host, _form, n, good, bad, _leaf) with the segments in _leaf that all longer forms of its node go on with."""
    rest = F.slice("_form", F.size("_leaf") + 1, F.greatest(F.size("_form") - F.size("_leaf"), F.lit(0)))
    forms = forms.withColumn("_rest", rest)
    ends = forms.where(F.size("_rest") > 0).groupBy(*NODE).agg(F.min("_rest").alias("_lo"), F.max("_rest").alias("_hi"))
    differ = F.array_position(F.zip_with("_lo", "_hi", lambda a, b: a.eqNullSafe(b)), False)
    shared = ends.select(*NODE, F.when(differ > 0, F.slice("_lo", F.lit(1), (differ - 1).cast("int"))).otherwise(F.col("_lo")).alias("_shared"))
    longer = F.when((F.size("_rest") > 0) & F.col("_shared").isNotNull(), F.concat("_leaf", "_shared")).otherwise(F.col("_leaf"))
    return salted_join(forms, shared, NODE, F.col("_form"), _hot(forms, NODE, skewed), "left").withColumn("_leaf", longer).drop("_rest", "_shared")


def _children(forms: DataFrame) -> DataFrame:
    """(_host, _leaf, _value, n, good, bad): the next segments at each node."""
    counts = (F.sum(c).alias(c) for c in ("n", "good", "bad"))
    return forms.withColumn("_value", F.get("_form", F.size("_leaf"))).where("_value IS NOT NULL").groupBy(*NODE, "_value").agg(*counts)


def _next_level(forms: DataFrame, children: DataFrame, skewed: bool) -> DataFrame:
    """``forms`` with one more segment of _form, as it is or as a wildcard, in _leaf."""
    forms = forms.withColumn("_value", F.get("_form", F.size("_leaf")))
    totals = children.groupBy(*NODE).agg(F.sum("n").alias("_all"))
    word = F.col("_value") != ANY
    rare = word & ((F.col("n") < LITERAL_PAGES) | (F.col("n") < LITERAL_SHARE * F.col("_all")))
    many = _hot(children, NODE, skewed)
    children = salted_join(children, totals, NODE, F.col("_value"), many).withColumn("_rare", rare)
    pools = (
        children.where(F.col("_rare") | ~word)
        .groupBy(*NODE)
        .agg(
            F.count_if("_rare").alias("_words"),
            F.count_if(F.col("_rare") & (F.col("good") + F.col("bad") > 0)).alias("_tests"),
            *(F.coalesce(F.sum(F.when(F.col("_rare") == kind, F.col(c))), F.lit(0)).alias(f"_{c}_{kind}".lower()) for c in ("good", "bad") for kind in (True, False)),
        )
    )
    words, digits = ((F.col(f"_good_{kind}"), F.col(f"_bad_{kind}")) for kind in ("true", "false"))
    both = _share(words[0] + digits[0], words[1] + digits[1])
    pools = pools.where("_words > 0").withColumns(
        {"_share": _share(*words), "_name": F.when(_apart(*words, both, F.lit(2)) | _apart(*digits, both, F.lit(2)), WORDS).otherwise(ANY)}
    )
    # A lone rare word has no siblings to be merged with; whether digits are like it is for _merged to tell.
    joins = (F.col("_words") > 1) & ~_apart(F.col("good"), F.col("bad"), F.col("_share"), F.col("_tests"))
    wild = (
        salted_join(children.where("_rare"), pools.select(*NODE, "_words", "_tests", "_share", "_name"), NODE, F.col("_value"), many)
        .where(joins)
        .select(*NODE, "_value", "_name")
    )
    step = F.coalesce("_name", "_value")
    return (
        salted_join(forms, wild, [*NODE, "_value"], F.col("_form"), _hot(forms, [*NODE, "_value"], skewed), "left")
        .withColumn("_leaf", F.when(step.isNotNull(), F.concat("_leaf", F.array(step))).otherwise(F.col("_leaf")))
        .drop("_value", "_name")
    )


def _generalised(forms: DataFrame, skewed: bool) -> tuple[DataFrame, list[int]]:
    """Adds ``_leaf`` to (_host, _form, n, good, bad): the form with its rare values as wildcards; and where nodes branch.

    One round for each branching of a path, whatever its length: what all forms of a node share is passed at once.
    """
    forms, places = forms.withColumn("_leaf", F.array().cast("array<string>")), set()
    while True:
        forms = written(_to_branch(forms, skewed), "url-leaves")
        children = written(_children(forms), "url-children")
        branched = {r[0] for r in children.select(F.size("_leaf")).distinct().collect()}
        if not branched:
            return forms, sorted(places)
        places |= branched
        forms = _next_level(forms, children, skewed)


def _merged(forms: DataFrame, at: int, skewed: bool) -> DataFrame:
    """Leaves that differ at one segment only, and whose purity is that of their pool, get a wildcard there.

    A leaf that has a wildcard there already is of the pool; where its purity is another, its siblings stay apart.
    """
    sums = [F.sum(c).alias(c) for c in ("good", "bad")]
    leaves = forms.groupBy("_host", "_leaf").agg(*sums).where(F.size("_leaf") > at)
    leaves = leaves.withColumn("_pool", F.transform("_leaf", lambda s, i: F.when(i == at, ANY).otherwise(s)))
    wild = F.get("_leaf", F.lit(at)) == ANY
    pools = leaves.groupBy("_host", "_pool").agg(
        F.sum("good").alias("_g"),
        F.sum("bad").alias("_b"),
        F.count(F.lit(1)).alias("_siblings"),
        *(F.coalesce(F.sum(F.when(wild, F.col(c))), F.lit(0)).alias(f"_{c}") for c in ("good", "bad")),
    )

    def alike(good: Column, bad: Column) -> Column:
        share, seen = _share(F.col("_g"), F.col("_b")), good + bad
        return F.abs(good - seen * share) <= SIMILAR * F.sqrt(seen * share * (1 - share))

    pools = pools.where((F.col("_siblings") > 1) & alike(F.col("_good"), F.col("_bad"))).drop("_good", "_bad")
    moves = (
        salted_join(leaves.where(~wild), pools, ["_host", "_pool"], F.col("_leaf"), _hot(leaves, ["_host", "_pool"], skewed))
        .where(alike(F.col("good"), F.col("bad")))
        .select("_host", "_leaf", "_pool")
    )
    return salted_join(forms, moves, ["_host", "_leaf"], F.col("_form"), _hot(forms, ["_host", "_leaf"], skewed), "left").withColumn("_leaf", F.coalesce("_pool", "_leaf")).drop("_pool")


def templates(pages: DataFrame, url: str = "url", good: str = "good") -> DataFrame:
    """(_host, _form, _pages, template, n, good, bad, purity, verdict): one row for each host and path form.

    ``_pages`` are those of the form, ``n`` those of its template. ``good`` is 1 or 0 on labelled pages and null on others; purity is smoothed towards the share of good labels.
    """
    forms = (
        pages.select(url_host(F.col(url)).alias("_host"), path_form(url_path(F.col(url))).alias("_form"), F.col(good).cast("int").alias("_label"))
        .groupBy("_host", "_form")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_label") == 1).alias("good"),
            F.count_if(F.col("_label") == 0).alias("bad"),
        )
    )
    forms = written(forms, "url-forms")
    skewed = bool(_hot(forms, ["_host"], True).hashes)
    forms, places = _generalised(forms, skewed)
    total = forms.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    prior = ((total["g"] or 0) + 1) / ((total["g"] or 0) + (total["b"] or 0) + 2) if (total["g"] or total["b"]) else 1.0
    for at in reversed(places):
        forms = written(_merged(forms, at, skewed), f"url-merged-{at}")
    leaves = forms.groupBy("_host", "_leaf").agg(*(F.sum(c).alias(f"_{c}") for c in ("n", "good", "bad")))
    purity = (F.col("_good") + SMOOTHING * F.lit(prior)) / (F.col("_good") + F.col("_bad") + SMOOTHING)
    rows = forms.select("_host", "_form", "_leaf", F.col("n").alias("_pages"))
    return salted_join(rows, leaves, ["_host", "_leaf"], F.col("_form"), _hot(rows, ["_host", "_leaf"], skewed)).select(
        "_host",
        "_form",
        "_pages",
        F.concat(F.col("_host"), F.lit("/"), F.array_join("_leaf", "/")).alias("template"),
        *(F.col(f"_{c}").alias(c) for c in ("n", "good", "bad")),
        purity.alias("purity"),
        F.when(purity < PURITY, "block").otherwise("allow").alias("verdict"),
    )


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = (), key: str = "page_id", url: str = "url", good: str = "good") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity), one row out for each page.

    The longest rule that fits decides; else the page's template. A null url, or one without ``://``, has an empty host
    and path and the template of those. Repeated rows are judged alike and count each; an empty table gives no rows; other
    columns are not carried. Without any label all templates are allowed.
    """
    judged = templates(pages, url, good).select("_host", "_form", "_pages", "template", "purity", F.col("verdict").alias("_method"))
    judged = written(judged, "url-templates")
    many = hot_keys(judged, ["_host", "_form"], "_pages")
    rows = pages.select(
        F.col(key), url_host(F.col(url)).alias("_host"), url_path(F.col(url)).alias("path"), F.xxhash64(F.col(key), F.col(url)).alias("_row")
    ).withColumn("_form", path_form(F.col("path")))
    rule = rule_for(F.col("_host"), F.col("path"), rules)
    return (
        salted_join(rows, judged.drop("_pages"), ["_host", "_form"], F.col("_row"), many)
        .withColumn("_rule", rule)
        .select(
            key,
            F.col("_host").alias("host"),
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce("_rule.verdict", "_method").alias("verdict"),
            "template",
            "purity",
        )
    )
