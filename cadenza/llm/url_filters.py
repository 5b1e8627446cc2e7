"""URL filters: pattern rules indexed by their rarest literal token, in DataFrame operations only.

A rule is a regular expression over the normal form ``host/path?query`` of a URL with the list
of literal tokens that every match must hold. The table of rules is keyed by the rarest of
these tokens, as counted over all URLs. A URL's tokens fetch the rules that could match, and
only those run their expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import UPPER, ascii_lower, settle

RULE_SCHEMA = "rule string, action string, rank int, tokens array<string>, pattern string"
#: A rule table up to this size is broadcast.
BROADCAST_BYTES = 8 << 20
TOKEN_BREAK = "[^a-z0-9]+"


@dataclass(frozen=True)
class PatternRule:
    """``rank`` orders rules that match the same URL: the largest decides."""

    rule: str
    action: str
    rank: int
    tokens: tuple[str, ...]
    pattern: str


def prefix_rule(action: str, host: str, path: str = "/") -> PatternRule:
    """A rule for a host with its subdomains and for paths that start with ``path``.

    It ranks above every other pattern, and the longer of two rules above the shorter.
    """
    name, quoted = f"{host}{path}", "".join(c if c.isalnum() or c in "/-_" else f"\\{c}" for c in host)
    whole_path = "".join(c if c.isalnum() or c in "/-_" else f"\\{c}" for c in path)
    # The last token of the path may go on in a URL, so it is no literal token unless a break follows.
    tokens = [t for t in _split(host.lower()) if t]
    in_path = _split(path)
    tokens += [t for t in in_path[:-1] if t and t == t.lower()]
    return PatternRule(name, action, 1_000_000 + len(name), tuple(dict.fromkeys(tokens)), rf"^([^/?]*\.)?{quoted}{whole_path}")


def _split(text: str) -> list[str]:
    out, token = [], ""
    for c in text:
        if c.isascii() and (c.isalnum()):
            token += c
        else:
            out.append(token)
            token = ""
    return [*out, token]


#: Rules in the manner of public ad and spam lists, for URLs without a rule for their host.
DEFAULT_PATTERNS = (
    PatternRule("casino hosts", "block", 5, ("casino",), r"^([^/?]*[.-])?casino[.-][^/?]*/"),
    PatternRule("pill shops", "block", 5, ("pills",), r"^([^/?]*[.-])?(cheap|online|buy)-pills[.-][^/?]*/"),
    PatternRule("betting hosts", "block", 5, ("bets",), r"^([^/?]*[.-])?(free|live)-bets[.-][^/?]*/"),
    PatternRule("spam farms", "block", 5, ("spam", "farm"), r"^([^/?]*\.)?spam-farm[.-][^/?]*/"),
    PatternRule("ad trackers", "block", 5, ("ads", "track"), r"^([^/?]*\.)?ads-track(er|ing)?[.-][^/?]*/"),
    PatternRule("campaign feeds", "block", 3, ("utm", "source", "feed"), r"\?(.*&)?utm_source=feed(&|$)"),
    PatternRule("archived pages", "allow", 4, ("html",), r"^[^?]*/\d+\.html$"),
)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows the path up to a fragment."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    query = F.regexp_extract(F.substring(rest, F.length(path) + 1, F.length(rest)), r"^([^#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path, query


def rule_table(spark: SparkSession, rules: tuple[PatternRule, ...]) -> DataFrame:
    """Rules as literals of the plan, for lists that are kept in code; longer lists come as a table."""
    rows = [F.struct(*map(F.lit, (r.rule, r.action, r.rank)), F.array(*map(F.lit, r.tokens)), F.lit(r.pattern)) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows).cast(f"array<struct<{RULE_SCHEMA}>>")))


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """Rows (id, host, path, rule, rank, verdict) for every page.

    The matching rule of the largest rank decides, ties by name; without one the verdict is
    ``default`` and the rule null. A null URL, or one without ``://``, has an empty host and
    path and matches nothing. Each row is judged by itself, so repeated rows give repeated
    results. A rule without a literal token is tried on every URL; a rule that is null in its
    pattern never matches. Equal URLs are judged once.
    """
    host, path, query = parts(F.col("url"))
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    rows = rows.select("id", "url", host.alias("host"), path.alias("path"), query.alias("query"))
    normal = F.concat("host", "path", "query")
    urls = rows.where("host <> ''").select("url", normal.alias("normal")).distinct()
    tokens = F.array_distinct(F.array_remove(F.split(ascii_lower(F.col("normal")), TOKEN_BREAK), ""))
    # The empty token fetches rules that have no literal token.
    asked = urls.select("url", "normal", F.explode(F.array_append(tokens, "")).alias("token"))

    spread = rules.where("pattern is not null").select("*", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    wanted = spread.select("token").distinct()
    held = F.length("pattern") + F.length("rule") + F.coalesce(F.length(F.array_join("tokens", "")), F.lit(0)) + 64
    size = rules.agg(F.coalesce(F.sum(held), F.lit(0))).first()[0]
    near = F.broadcast if size <= BROADCAST_BYTES else lambda frame: frame
    counts = asked.join(near(wanted), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token")
    index = settle(spread.join(counts, "token", "left").groupBy("rule", "action", "rank", "pattern").agg(rarest), "rule-index")
    fetched = asked.join(near(index), "token")
    matched = fetched.where(F.expr("normal rlike pattern"))
    best = matched.groupBy("url").agg(F.max(F.struct("rank", "rule", "action")).alias("best"))
    return rows.join(best, "url", "left").select(
        "id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.rank").alias("rank"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
