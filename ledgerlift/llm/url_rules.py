"""URL filters: many rules, of which a URL tests only those that its own tokens fetch.

A rule's literal tokens are the runs of letters and digits that any URL it fits must hold as whole runs.
Each rule is indexed under the one of them that the fewest URLs of the corpus hold; a URL looks up its
tokens, and only rules met that way run their regular expression.  Rules without a literal token are met
by every URL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm.common import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TOKEN = "[a-z0-9]+"
SITE, HOST, PATTERN, REGEX = "site", "host", "pattern", "regex"
#: What a page without a rule gets.
DEFAULT = "allow"
#: Words of hosts of advertising, gambling, adult content, medicine trade and abuse.
HOSTS = ("^ads^", "^adserver^", "^adult^", "^bets^", "^betting^", "^casino^", "^escorts^", "^gambling^", "^malware^", "^phishing^", "^pills^", "^poker^", "^porn^", "^spam^", "^viagra^", "^warez^", "^xxx^")
#: Pages that hold no prose, and the exceptions to them (``@@``).
PATTERNS = (
    "||doubleclick.net^",
    "/ads/banner*^",
    "/login^",
    "/signup^",
    "/cart^",
    "/checkout^",
    "/cgi-bin/*.exe^",
    "/wp-login.php",
    "^sessionid=",
    "^phpsessid=",
    "^replytocom=",
    ".apk|",
    ".exe|",
    ".zip|",
    "@@||archive.org^",
    "@@/docs/*/login^",
)


def folded(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return folded(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rules(spark: SparkSession, sites: Iterable[tuple[str, str]] = (), hosts: Iterable[str] = HOSTS, patterns: Iterable[str] = PATTERNS, regexes: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """(rule, kind, verdict) of a short list; a long one is a table with these columns.

    * ``site``: ``host/path`` fits that host and its subdomains, where the path starts as the rule's does.
    * ``pattern``: a piece of a lower-cased URL; ``*`` stands for anything, ``^`` for the start, the end or
      any character but a letter a-z or a digit.  ``||`` in front stands for the start of the host or of one
      of its labels, ``|`` in front or at the end for the start or end of the URL.  Block, or allow with
      ``@@`` in front.
    * ``host``: the same for a piece of the host.
    * ``regex``: a regular expression, found anywhere in the lower-cased URL.
    """
    rows = [(r, SITE, v) for r, v in sites] + [(r, REGEX, v) for r, v in regexes]
    rows += [(p.removeprefix("@@"), kind, "allow" if p.startswith("@@") else "block") for kind, listed in ((HOST, hosts), (PATTERN, patterns)) for p in listed]
    return spark.createDataFrame(rows, "rule string, kind string, verdict string")


def _quoted(text: Column, wild: str = "") -> Column:
    return F.regexp_replace(text, rf"([^\p{{L}}\p{{N}}{wild}])", r"\\$1")


def compiled(table: DataFrame) -> DataFrame:
    """(rule, kind, verdict, regex, tokens) of the rules that have all three columns; others fit nothing.

    A token counts where something that is no part of a token bounds it on both sides.
    """
    text = F.col("rule")
    whole = table.select(text, "kind", "verdict").where("rule is not null and kind is not null and verdict is not null").distinct()
    cut = F.instr(text, "/")
    site = F.when(cut > 0, F.concat(folded(F.substring(text, F.lit(1), cut)), F.substring(text, cut + 1, F.length(text)))).otherwise(F.concat(folded(text), F.lit("/")))
    site_regex = F.concat(F.lit(r"^(?:[^/]*\.)?"), _quoted(site))
    pattern = folded(text)
    label, front, back = pattern.startswith("||"), pattern.startswith("|"), pattern.endswith("|")
    body = F.regexp_replace(pattern, r"^\|{1,2}|\|$", "")
    wild = F.replace(F.replace(_quoted(body, r"*\^"), F.lit("*"), F.lit(".*")), F.lit("^"), F.lit(r"(?:[^a-z0-9]|\A|\z)"))
    start = F.when(label, F.lit(r"^[^:/?#]*://(?:[^/?#]*\.)?")).when(front, F.lit("^")).otherwise(F.lit(""))
    pattern_regex = F.concat(F.lit("(?s)"), start, wild, F.when(back, F.lit(r"\z")).otherwise(F.lit("")))
    bounded = F.concat(F.when(front, F.lit("^")).otherwise(F.lit("*")), body, F.when(back, F.lit("^")).otherwise(F.lit("*")))
    bounded = F.when(F.col("kind") == SITE, F.concat(F.lit("^"), folded(site), F.lit("*"))).when(F.col("kind") != REGEX, bounded).otherwise(F.lit(""))
    regex = F.when(F.col("kind") == SITE, site_regex).when(F.col("kind") != REGEX, pattern_regex).otherwise(text)
    tokens = F.array_distinct(F.regexp_extract_all(bounded, F.lit(rf"(?<=[^a-z0-9*])({TOKEN})(?=[^a-z0-9*])"), F.lit(1)))
    return whole.select("rule", "kind", "verdict", regex.alias("regex"), tokens.alias("tokens"))


def tokens_of(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded(url), F.lit(f"({TOKEN})"), F.lit(1)))


def index(urls: DataFrame, table: DataFrame) -> DataFrame:
    """(token, rule, kind, verdict, regex): each rule under the token that the fewest rows of `urls` (url) hold.

    A rule without literal tokens stands under the empty one.  Only tokens of rules are counted.  Rules
    are written first, so that Spark knows their size when it plans the joins.
    """
    spread = written(compiled(table).withColumn("token", F.explode_outer("tokens")), "url-rule-tokens")
    asked = spread.select("token").where("token is not null").distinct()
    held = urls.select(F.explode(tokens_of(F.col("url"))).alias("token")).join(asked, "token", "left_semi")
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token")))
    chosen = spread.join(counts, "token", "left").groupBy("rule", "kind", "verdict", "regex").agg(rarest.alias("r"))
    return chosen.select(F.coalesce("r.token", F.lit("")).alias("token"), "rule", "kind", "verdict", "regex")


def judged(df: DataFrame, table: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """A row for each row of `df`: id, host, path, rule, verdict and pattern.

    ``rule`` is the site rule that fits, the longest first, then the greatest text; the verdict is its own.
    Without one the verdict is that of the patterns and regular expressions that fit, allow before block,
    then the longest, which is named in ``pattern``; with none of them it is `default`.  A null url fits
    nothing.  Null ids stay; repeated rows come out as often as they go in; an empty table gives an
    empty result; further columns of `df`, whatever their names, don't matter.

    URLs meet the rules as Spark plans it: a short list is broadcast, a long one shuffled by token.  What
    fits is joined to the rows by url, where Spark splits a url that many rows share.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    named = rows.where("url is not null").select("url")
    entries = written(index(named, table), "url-rules").withColumnRenamed("token", "t")
    fetched = F.explode(F.concat(F.array(F.lit("")), tokens_of(F.col("url"))))
    met = named.select("url", fetched.alias("token")).join(entries, F.col("token") == F.col("t"))
    host, path, kind = host_of(F.col("url")), path_of(F.col("url")), F.col("kind")
    subject = F.when(kind == SITE, F.concat(host, path)).when(kind == HOST, host).otherwise(folded(F.col("url")))
    fits = met.where(F.rlike(subject, F.col("regex")))
    site = kind == SITE
    order = F.struct(site.alias("site"), (~site & (F.col("verdict") == "allow")).alias("exception"), F.length("rule").alias("length"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))
    best = fits.groupBy(F.col("url").alias("u")).agg(F.max(order).alias("best"))
    joined = rows.join(best, F.col("url") == F.col("u"), "left")
    rule, pattern = F.when(F.col("best.site"), F.col("best.rule")), F.when(~F.col("best.site"), F.col("best.rule"))
    return joined.select(
        F.col("id").alias(id_col),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        rule.alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        pattern.alias("pattern"),
    )
