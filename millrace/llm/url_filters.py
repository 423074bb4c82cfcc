"""URL filters: host-suffix and path-prefix expressions, joined by hash prefix, confirmed by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower

#: A rule list of at most this many bytes is broadcast; a longer one is joined by a shuffle.
BROADCAST_RULE_BYTES = 8 << 20
DIGEST_BYTES = 32
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with digest and precedence, one for each host and path.

    The longest host plus path wins, then the longer host; of one rule with both actions, block.
    Rules with a null or empty host, a null path or another action than allow and block fit nothing.
    """
    kept = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "action").where(
        (F.col("host") != "") & F.col("path").isNotNull() & F.col("action").isin("allow", "block")
    )
    # "block" is the larger word.
    kept = kept.groupBy("host", "path").agg(F.max("action").alias("action"))
    digest = _digest(F.col("host"), F.col("path"))
    return kept.select(
        F.struct(
            (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"), F.col("action").alias("verdict"),
        ).alias("hit"),
        F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("path_length"),
        digest.alias("digest"), _prefix(digest).alias("prefix"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns ``keep`` of every page, and host, path, rule and verdict.

    A rule fits its host and all subdomains of it when the path starts with the rule's path. A page
    that no rule fits has rule null and the verdict "allow". A null URL, or one without ``://``, has
    an empty host and path, which no rule fits. Repeated pages each get their row; other columns of
    the input are not looked at, whatever their names. Without rules every page is allowed.

    Hosts and paths are made distinct before they are expanded, so a URL that fills a third of the
    table is judged once. Only suffixes of as many labels, and prefixes of as many characters, as
    some rule has are made; what is broadcast is the rule list, and only if its bytes are few.
    """
    prepared = prepare_rules(rules)
    shape = prepared.agg(
        F.count("*"), F.sum(F.octet_length("hit.rule") + 2 * DIGEST_BYTES),
        F.sort_array(F.collect_set("labels")), F.sort_array(F.collect_set("path_length")),
    ).first()
    split = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    nothing = [F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT_VERDICT).alias("verdict")]
    if not shape[0]:
        return split.select("*", *nothing)
    labels, n = F.split("host", r"\.", -1), F.size(F.split("host", r"\.", -1))
    suffixes = F.array_compact(F.array(*[
        F.when(n >= k, F.concat_ws(".", F.slice(labels, n - (k - 1), k))) for k in shape[2]
    ]))
    prefixes = F.array_compact(F.array(*[
        F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in shape[3]
    ]))
    digest = _digest(F.col("suffix"), F.col("start"))
    expressions = (
        split.select("host", "path").where("host != ''").distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(prefixes).alias("start"))
        .select("host", "path", digest.alias("digest"), _prefix(digest).alias("prefix"))
    )
    listed = prepared.select("prefix", F.col("digest").alias("rule_digest"), "hit")
    if shape[1] <= BROADCAST_RULE_BYTES:
        listed = F.broadcast(listed)
    best = (
        expressions.join(listed, "prefix").where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path").agg(F.max("hit").alias("hit"))
    )
    return split.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
