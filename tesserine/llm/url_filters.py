"""URL filters: listed rules first, then association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import LOWER, UPPER, join_hot, materialize

#: (verdict, host, path)
LISTED = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
INDEX_ROWS = 20_000  # rules that are sent to every task
MOST_TOKENS = 12  # of a labelled URL that FP-growth reads; with more of them anywhere all go through generators
LABEL = "="  # starts the items that are labels; no URL token starts with it


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.substring_index(F.regexp_replace(after_scheme(url), "[/?#]", "/"), "/", 1)
    return F.translate(rest, UPPER, LOWER)


def after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits; nulls if none does."""
    rule = verdict = None
    for what, at, under in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        rule = F.when(fits, F.lit(at + under)) if rule is None else rule.when(fits, F.lit(at + under))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    return rule, verdict


def tested(rule: Column, rules=LISTED) -> Column:
    """The tokens that the listed rule tests: the labels of its host, the segments of its path."""
    out = F.array().cast("array<string>")
    for _, at, under in rules:
        own = [f"h:{x}" for x in at.split(".") if x] + [f"p:{x}" for x in under.split("/") if x]
        out = F.when(rule == at + under, F.array(*map(F.lit, own))).otherwise(out)
    return out


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, labels of the host, segments of the path, names of query fields, fragment."""
    tagged = lambda tag, xs: F.transform(F.filter(xs, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            tagged("s:", F.array(F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z]*)://", 1))),
            tagged("h:", F.split(host, r"\.")),
            tagged("p:", F.split(path, "/")),
            tagged("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
            F.when(F.coalesce(url, F.lit("")).contains("#"), F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
        )
    )


def bounded(labelled: DataFrame, most: int) -> DataFrame:
    """labelled, whose baskets keep their `most` most frequent tokens (ties by name). filter_urls mines whole baskets and doesn't use it."""
    many = labelled.where(F.size("tokens") > most)
    if many.isEmpty():
        return labelled
    counts = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    each = labelled.where(F.size("tokens") > most).groupBy("tokens").agg(F.count("*").alias("_n")).withColumn("token", F.explode("tokens")).join(counts, "token")
    kept = each.groupBy("tokens").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "token"))), 1, most)["token"].alias("_kept"), F.first("_n").alias("_n"))
    total = labelled.count()
    out = join_hot(many, kept, ["tokens"], "_n", total).withColumn("tokens", F.col("_kept"))
    return labelled.where(F.size("tokens") <= most).unionByName(out.select(*labelled.columns))


def generators(labelled: DataFrame, least: int, total: int) -> DataFrame:
    """(items, verdict, n, m): the token combinations in m >= least of the `total` labelled URLs, n of them with the verdict, that may give a rule.

    A combination in as many URLs as one of its parts has that part's confidence, and one with a part of a single verdict has no other; both
    are implied by the part and so are all that hold them. What is left grows level by level, each from combinations whose parts are all left,
    so that a template of many fixed tokens costs no more than its tokens. URLs are counted where the first token of a combination meets
    them.
    """
    sets = labelled.groupBy(F.array_sort(F.array_distinct("tokens")).alias("set"), "verdict").agg(F.count("*").alias("n"))
    sets = materialize(sets.where(F.size("set") > 0), "url-sets")
    each = sets.select("set", "verdict", "n", F.explode("set").alias("token"))
    often = materialize(each.groupBy("token").agg(F.sum("n").alias("m")).where(F.col("m") >= least), "url-often")
    kept = each.join(often.select("token"), "token").groupBy("set", "verdict").agg(F.array_sort(F.collect_list("token")).alias("basket"), F.first("n").alias("n"))
    kept = materialize(kept.groupBy("basket", "verdict").agg(F.sum("n").alias("n")), "url-baskets")
    probes = kept.withColumn("token", F.explode("basket"))
    asked, out, size = often.select(F.array("token").alias("items"), F.lit(total + 1).alias("least_part")), None, 1
    while True:
        met = probes.join(asked.withColumn("token", F.col("items")[0]), "token").where(F.size(F.array_except("items", "basket")) == 0)
        one = met.groupBy("items", "least_part", "verdict").agg(F.sum("n").alias("n"))
        per = one.groupBy("items", "least_part").agg(F.sum("n").alias("m"), F.max("n").alias("most"), F.collect_list(F.struct("verdict", "n")).alias("by"))
        per = materialize(per.where((F.col("m") >= least) & (F.col("m") < F.col("least_part"))), "url-level")
        found = per.select("items", F.explode("by").alias("by"), "m").select("items", "by.verdict", "by.n", "m")
        out = found if out is None else out.unionByName(found)
        left = per.where((F.col("most") < F.col("m")) & (F.col("most") >= least)).select("items", "m", F.slice("items", 1, size - 1).alias("head"), F.element_at("items", -1).alias("last"))
        longer = left.select("items", "head", "last").join(left.select("head", F.col("last").alias("then")), "head").where(F.col("last") < F.col("then"))
        longer = longer.select(F.concat("items", F.array("then")).alias("items"))
        parts = longer.withColumn("part", F.explode(F.transform("items", lambda x: F.array_remove("items", x))))
        asked = parts.join(left.select(F.col("items").alias("part"), "m"), "part").groupBy("items").agg(F.count("*").alias("_parts"), F.min("m").alias("least_part"))
        asked = materialize(asked.where(F.col("_parts") == size + 1).drop("_parts"), "url-asked")
        if asked.isEmpty():
            return out
        size += 1


def mine_rules(labelled: DataFrame, *, min_support: float, min_confidence: float, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """(items, verdict, confidence, support): token combinations that imply a label.

    labelled has the columns tokens and verdict. FP-growth counts the combinations of tokens and labels; those with a
    label give rules. A rule stays if its confidence is high enough and no rule on a part of its tokens says the same
    with as much confidence. Of rules there are at most as many as min_support lets through, whatever the input.

    FP-growth counts all subsets of fixed tokens: where a basket holds more than `most_tokens`, the combinations that may give a rule come
    from `generators` instead, which leaves out only those that a part implies. The rules are the same.
    """
    if labelled.where(F.size("tokens") > most_tokens).isEmpty():
        baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
        is_label = lambda x: x.startswith(LABEL)
        rules = model.associationRules.where(
            F.forall("consequent", is_label) & ~F.exists("antecedent", is_label)
        ).select(
            F.array_sort("antecedent").alias("items"), F.substring(F.col("consequent")[0], 2, 2**31 - 1).alias("verdict"), "confidence", "support"
        )
    else:
        total = labelled.count()
        least = math.ceil(min_support * total)
        rules = generators(labelled, least, total).withColumn("confidence", F.col("n").cast("double") / F.col("m"))
        rules = rules.where((F.col("n") >= least) & (F.col("confidence") >= min_confidence)).select("items", "verdict", "confidence", (F.col("n").cast("double") / total).alias("support"))
    rules = materialize(rules, "url-rules")
    shorter = rules.select(F.col("items").alias("part"), F.col("verdict").alias("says"), F.col("confidence").alias("sure"))
    inside = (
        (F.col("says") == F.col("verdict"))
        & (F.size("part") < F.size("items"))
        & (F.size(F.array_except("part", "items")) == 0)
        & (F.col("sure") >= F.col("confidence"))
    )
    parts = rules.withColumn("_item", F.explode("items"))
    implied = parts.join(shorter.withColumn("_item", F.col("part")[0]), "_item").where(inside).select("items", "verdict").distinct()
    return rules.join(implied, ["items", "verdict"], "left_anti")


def anchor(rules: DataFrame) -> DataFrame:
    """Rules with their rarest token, the one in the fewest rules."""
    tokens = rules.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return (
        rules.withColumn("token", F.explode("items"))
        .join(tokens, "token")
        .groupBy("items", "verdict", "confidence", "support")
        .agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    )


def proven(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """rules, of those that block only the ones whose blocked URLs come from several listed rules and several hosts.

    A rule known from one of either says where that rule applies or what that host is; one that holds on several is one that the URLs of
    any of these would have been blocked by, had their own rule not been listed. A listed rule whose tokens are all in a mined one is no
    evidence for it, as that only repeats it. labelled has the columns tokens, verdict, rule, tested and host.
    """
    seen = labelled.where(F.col("verdict") == "block").select("tokens", "rule", "tested", "host", F.explode("tokens").alias("token"))
    hits = seen.join(anchor(rules.where(F.col("verdict") == "block")), "token").where((F.size(F.array_except("items", "tokens")) == 0) & (F.size(F.array_except("tested", "items")) > 0))
    several = lambda c: F.min(c) != F.max(c)
    held = hits.groupBy("items").agg((several("rule") & several("host")).alias("_held"))
    kept = rules.join(held, "items", "left").where((F.col("verdict") != "block") | F.col("_held"))
    return materialize(kept.drop("_held"), "url-proven")


def match_rules(urls: DataFrame, rules: DataFrame, *, key: str) -> DataFrame:
    """(key, verdict) of the most confident rule that matches each URL's tokens; ties: more support, then block.

    The rules are indexed by their rarest token (the one in the fewest rules); each URL probes with its tokens and
    the tokens left of a probed rule are checked in the row. An index of at most INDEX_ROWS rules is broadcast; a larger one is
    joined by token, with the tokens of a thousandth of the probes or more dealt over salts.
    """
    index = materialize(anchor(rules), "url-index")
    probes = urls.select(key, "tokens", F.explode("tokens").alias("token"))
    if index.limit(INDEX_ROWS + 1).count() <= INDEX_ROWS:
        met = probes.join(F.broadcast(index), "token")
    else:
        probes = materialize(probes.join(index.select("token").distinct(), "token", "left_semi"), "url-probes")
        of = probes.groupBy("token").agg(F.count("*").alias("_n"))
        several = index.groupBy("token").agg(F.collect_list(F.struct("items", "verdict", "confidence", "support")).alias("_rules")).join(of, "token")
        met = join_hot(probes, several, ["token"], "_n", probes.count()).withColumn("_rule", F.explode("_rules")).select(key, "tokens", "token", "_rule.*")
    hits = met.where(F.size(F.array_except("items", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", "verdict"))
    return hits.groupBy(key).agg(best.alias("best")).select(key, F.col("best.verdict").alias("mined"), F.col("best.confidence").alias("confidence"))


def _labelled(pages: DataFrame, rules) -> DataFrame:
    """page_id, url, host, path, rule, listed (its verdict) and tokens of each page."""
    base = pages.select("page_id", F.col("url").cast("string").alias("url"))
    base = base.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    base = base.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("listed"))
    return base.withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))


def filter_urls(pages: DataFrame, *, rules=LISTED, min_support: float = 0.01, min_confidence: float = 0.9, default: str = "allow", most_tokens: int = MOST_TOKENS) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, confidence.

    The longest listed rule that fits decides. The URLs that listed rules decide are the labels from which FP-growth
    mines token combinations; those that are `proven` decide the others, and `default` what no rule reaches. Mining reads all
    tokens of a labelled URL; see mine_rules for those of more than `most_tokens`. Columns other than page_id
    and url are ignored; a null url has an empty host and path, no tokens and the default verdict; repeated page_ids
    are judged row by row by their url; an empty table gives an empty result. Only DataFrame functions are used.
    """
    base = _labelled(pages, rules)
    labelled = base.where(F.col("listed").isNotNull()).select("tokens", F.col("listed").alias("verdict"), "rule", tested(F.col("rule"), rules).alias("tested"), "host")
    mined = proven(mine_rules(labelled, min_support=min_support, min_confidence=min_confidence, most_tokens=most_tokens), labelled)
    # URLs with the same tokens get the same verdict: each set of tokens is matched once.
    listed = base.where(F.col("listed").isNotNull()).select("page_id", "host", "path", "rule", F.col("listed").alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    rest = base.where(F.col("listed").isNull()).withColumn("_set", F.array_sort("tokens"))
    sets = rest.groupBy("_set").agg(F.count("*").alias("_n")).withColumn("tokens", F.col("_set"))
    sets = materialize(sets.join(match_rules(sets, mined, key="_set"), "_set", "left").select("_set", "_n", "mined", "confidence"), "url-sets")
    total = sets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rest = join_hot(rest.select("page_id", "host", "path", "rule", "_set"), sets, ["_set"], "_n", total)
    return listed.unionByName(rest.select("page_id", "host", "path", "rule", F.coalesce("mined", F.lit(default)).alias("verdict"), "confidence"))


def held_out_report(pages: DataFrame, *, rules=LISTED, min_support: float = 0.01, min_confidence: float = 0.9, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """(rule, pages, blocked, allowed_pages, allowed_blocked): for each listed block rule what mining says of its pages, and of half of the pages that listed
    rules allow, when neither are among the labels.

    Mined rules then need no evidence from several listed rules, as one of those is out; precision is blocked over
    blocked and allowed_blocked, recall blocked over pages."""
    base = _labelled(pages, rules).where(F.col("listed").isNotNull())
    half = F.pmod(F.xxhash64("url"), F.lit(2)) == 0
    base = materialize(base.select("tokens", F.col("listed").alias("verdict"), "rule", half.alias("half")), "url-labels")
    out = None
    for name in sorted({at + under for what, at, under in rules if what == "block"}):
        asked = (F.col("rule") == name) | ((F.col("verdict") == "allow") & F.col("half"))
        mined = mine_rules(base.where(~asked).select("tokens", "verdict"), min_support=min_support, min_confidence=min_confidence, most_tokens=most_tokens)
        sets = base.where(asked).select(F.array_sort("tokens").alias("_set"), "verdict").groupBy("_set", "verdict").agg(F.count("*").alias("_n")).withColumn("tokens", F.col("_set"))
        found = sets.join(match_rules(sets.dropDuplicates(["_set"]), mined, key="_set"), "_set", "left")
        count = lambda verdict, hit: F.coalesce(F.sum(F.when((F.col("verdict") == verdict) & (F.lit(True) if not hit else F.col("mined") == "block"), F.col("_n"))), F.lit(0))
        one = found.agg(count("block", False).alias("pages"), count("block", True).alias("blocked"), count("allow", False).alias("allowed_pages"), count("allow", True).alias("allowed_blocked"))
        one = one.select(F.lit(name).alias("rule"), "*")
        out = one if out is None else out.unionByName(one)
    return out
