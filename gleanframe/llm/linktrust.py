"""URL filters: rules first, then trust and distrust propagated over the links between hosts.

Rules judge the urls they fit. The hosts of those urls are seeds: trusted by the share of their
ruled pages that is allowed, distrusted by the share that is blocked. A personalised PageRank
walks from the trusted seeds along the links, another from the distrusted seeds against them,
and a host whose distrust outweighs its trust is blocked. Ranks are whole numbers, so that sums
do not depend on their order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import lower_ascii, stored

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
#: Hosts of absolute and scheme-relative links.
LINK_HOST = r"""(?i)\bhref[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\x5C\x20\x09-\x0D]+)"""
#: The rank of one whole seed; with a thousand million hosts all sums stay within 64 bits.
SEED = 100_000_000
DAMPING_PERCENT = 85
ROUNDS = 20
#: Rounds in one plan; then the ranks are written down.
STRIDE = 5
#: Links of one host that go into one group of a round.
GROUP = 10_000
#: A host with more than this share of the pages is heavy; there are at most that many.
HEAVY = 1_000


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The name of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.name)).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct (a, b): a page of host a names host b in a link, or b is a's parent host or child host.

    ``pages`` has host and html. A host belongs to the host that its name ends with after the
    first dot, if that host has pages, and the two count as linked both ways.
    """
    named = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK_HOST), F.lit(1)))
    linked = pages.select(F.col("host").alias("a"), F.explode(named).alias("b")).select("a", lower_ascii(F.col("b")).alias("b"))
    hosts = pages.select("host").distinct()
    parents = hosts.select(F.col("host").alias("a"), F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("b"))
    up = parents.join(hosts.select(F.col("host").alias("b")), "b", "left_semi").select("a", "b")
    down = up.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return linked.unionByName(up).unionByName(down).where("a <> '' AND b <> '' AND a <> b").distinct()


def _steps(links: DataFrame) -> DataFrame:
    """(kind, host, part, parts, next, degree): links forward for trust, backward for distrust.

    The links of a host are dealt to ``parts`` groups of about ``GROUP``, so no hub is one group.
    """
    forward = links.select(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("next"))
    backward = links.select(F.lit("distrust").alias("kind"), F.col("b").alias("host"), F.col("a").alias("next"))
    both = forward.unionByName(backward)
    degrees = both.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    parts = F.ceil(F.col("degree") / GROUP).cast("int")
    return both.join(degrees, ["kind", "host"]).select(
        "kind", "host", F.pmod(F.hash("next"), parts).alias("part"), "next", "degree"
    )


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING_PERCENT) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` steps from ``seeds`` (host, trust, distrust: whole numbers).

    A host hands on ``damping`` percent of its rank in equal parts, rounded down; what a host
    without links would hand on is gone. No seeds or no links: seeds keep their own share.
    """
    steps = stored(_steps(links), "host-links")
    hubs = steps.groupBy("kind", "host").agg((F.max("part") + 1).alias("parts")).where("parts > 1")
    hubs = stored(hubs, "hubs")
    walks = [seeds.select(F.lit(kind).alias("kind"), "host", F.col(kind).alias("rank")).where("rank > 0") for kind in ("trust", "distrust")]
    seed = stored(walks[0].unionByName(walks[1]), "seeds")
    own = seed.select("kind", "host", F.expr(f"{100 - damping} * rank div 100").alias("rank"))
    ranks = seed
    for done in range(1, rounds + 1):
        dealt = ranks.join(hubs, ["kind", "host"], "left").select(
            "kind", "host", "rank", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        )
        share = F.expr(f"{damping} * (rank div degree) div 100")
        handed = dealt.join(steps, ["kind", "host", "part"]).select("kind", F.col("next").alias("host"), share.alias("rank"))
        ranks = handed.unionByName(own).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if done % STRIDE == 0:
            ranks = stored(ranks, "ranks")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0)).alias(kind)
    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def filter_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rounds: int = ROUNDS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of ``pages``.

    ``rule`` names the longest rule that fits, and its verdict holds. Without one the host
    decides: blocked if its distrust exceeds its trust, else allowed (hosts without links or
    seeds too). Null urls and urls without ``://`` have empty host and path, fit no rule and are
    allowed. Null html has no links. Rows are judged one by one: repeated rows and null ids need
    no rule, though each row of a host counts in its seed. An empty table gives an empty result.
    """
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("two rules for one host and path")
    url = F.col(url_col)
    given = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html_col).alias("html"))
    given = given.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.lit(None).cast("string")
    for rule in rules:
        verdicts = F.when(F.col("rule") == rule.name, F.lit(rule.verdict)).otherwise(verdicts)
    given = given.withColumn("ruled", verdicts)
    hosts = given.groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count("ruled").alias("ruled"),
        F.count_if(F.col("ruled") == "allow").alias("allowed"),
    )
    hosts = stored(hosts, "hosts")
    share = lambda count: F.expr(f"{SEED} * ({count}) div ruled")
    seeds = hosts.where("ruled > 0 AND host <> ''").select(
        "host", share("allowed").alias("trust"), share("ruled - allowed").alias("distrust")
    )
    ranks = propagate(host_links(given), seeds, rounds)
    judged = hosts.join(ranks, "host", "left").select(
        "host",
        "pages",
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
    judged = stored(judged.withColumn("judged", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")), "judged-hosts")
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    # a host of more than a thousandth of all pages: at most a thousand of them, whatever the size
    heavy = F.broadcast(judged.where(F.col("pages") * HEAVY > total).drop("pages"))
    light = judged.where(F.col("pages") * HEAVY <= total).drop("pages")
    rows = given.drop("html")
    named = rows.join(heavy, "host")
    others = rows.join(heavy, "host", "left_anti").join(light, "host")
    both = named.unionByName(others)
    return both.select("page_id", "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"), "trust", "distrust")
