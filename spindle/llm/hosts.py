"""URL filters: path rules, and for the rest an empirical-Bayes reputation of the host.

A rule (host, path, verdict) fits pages of its host and of all subdomains whose path
starts with the rule's; the longest fitting rule decides.  A page without a rule is
judged by its host's record of labelled outcomes (blocked or not).  Records are shrunk
through beta-binomial priors, from host to registered domain to suffix to the whole
table:

* each level's strength is estimated from the data: the intraclass correlation rho of its
  groups' shares around their parent's mean (method of moments), strength 1/rho - 1;
* a group's mean is (blocked + strength * parent's mean) / (labelled + strength);
* a host's posterior is Beta(a, b) around its domain's mean, and the page is blocked when
  the posterior's lower bound, mean - z * standard deviation, reaches ``block_at``.

The outcome is any Boolean column (null: not labelled).  By default the rules' own
verdicts are the labelled outcomes: ``labels`` covers documents, and no column links a
page to one of them.

The suffix is a host's last label, or its last two where those are in ``SUFFIXES``; the
registered domain is one label more; hosts of digits and dots are their own domain.

Hot hosts, domains and suffixes: outcomes are counted with partial sums; the keys that
hold more than a thousandth of the rows each (fewer than a thousand keys) are joined by
broadcast, the others by a shuffle in which no key is larger than that.

Defined cases: a null url or one without ``://`` has an empty host and path, is judged like
any host of that name, and no rule fits it; ports and user names are part of the host as
written; a null rule host or path never fits; equal rules of opposite verdict: block wins;
without labelled outcomes every page outside the rules is allowed; repeated pages count as
often as they occur; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import keep

BLOCK_AT, Z = 0.5, 1.645
RHO_LEAST, RHO_MOST = 0.001, 0.95
HOT_SHARE = 1000

# Suffixes of two labels under which names are registered.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
            "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")


@dataclass(frozen=True)
class Rule:
    host: str | None
    path: str | None
    block: bool

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    at_host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
    return at_host & F.col("path").startswith(rule.path)


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` (null: none fits) and ``ruled`` (whether it blocks) to rows with ``host`` and ``path``."""
    usable = [r for r in rules if r.host is not None and r.path is not None]
    usable = sorted(usable, key=lambda r: (-len(r.name), r.name, not r.block))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for r in reversed(usable):
        rule, ruled = F.when(_fits(r), F.lit(r.name)).otherwise(rule), F.when(_fits(r), F.lit(r.block)).otherwise(ruled)
    return pages.withColumn("rule", rule).withColumn("ruled", ruled)


def suffix(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return (F.when(host.rlike(r"^[0-9.]*$"), F.lit(""))
            .when(last_two.isin(*suffixes), last_two).otherwise(F.substring_index(host, ".", -1)))


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return (F.when(host.rlike(r"^[0-9.]*$"), host)
            .when(last_two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(last_two))


def _strength(groups: DataFrame) -> float:
    """1/rho - 1 of rows (parent, n, k, parent_n, parent_k, mean): groups within parents, ``mean`` the parent's.

    Moments over all groups at once: with p = k/n, the weighted squared distance of the
    shares from their parent's, against what binomial noise alone would give.  Terms are
    summed as whole millionths, so the sum does not depend on the order of rows.
    """
    p, mean = F.col("k") / F.col("n"), F.col("parent_k") / F.col("parent_n")
    noise = mean * (1 - mean)
    rest = 1 - F.col("n") / F.col("parent_n")
    whole = lambda x: F.sum(F.floor(1e6 * x).cast("decimal(38,0)")).cast("double")
    row = groups.filter("n > 0").agg(
        whole(F.col("n") * (p - mean) * (p - mean)).alias("seen"),
        whole(noise * rest).alias("by_chance"),
        whole(noise * F.col("n") * rest).alias("at_most")).first()
    spread = (row["at_most"] or 0.0) - (row["by_chance"] or 0.0)
    rho = (row["seen"] - row["by_chance"]) / spread if spread > 0 else RHO_LEAST
    return 1 / min(max(rho, RHO_LEAST), RHO_MOST) - 1


def _join_uneven(rows: DataFrame, groups: DataFrame, on: list[str], members: str, hot_share: int = HOT_SHARE) -> DataFrame:
    """``rows`` joined with their group; ``members`` is each group's number of rows and is dropped.

    Groups of more than 1/hot_share of the rows, of which there are fewer than
    ``hot_share``, are joined by broadcast, the rest by a shuffle.
    """
    total = groups.agg(F.coalesce(F.sum(members), F.lit(0))).first()[0]
    hot = F.col(members) * hot_share > total
    few, rest = groups.filter(hot).drop(members), groups.filter(~hot).drop(members)
    return (rows.join(F.broadcast(few), on)
            .unionByName(rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(rest, on)))


def host_reputations(hosts: DataFrame, block_at: float = BLOCK_AT, z: float = Z,
                     suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``host``, ``labelled``, ``blocked``, ``bound`` and ``bad`` from rows (host, n, k) of labelled outcomes.

    Other columns of ``hosts`` are kept.
    """
    others = [c for c in hosts.columns if c not in ("host", "n", "k")]
    top = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    if not top["n"]:
        return hosts.select("host", *others, F.col("n").alias("labelled"), F.col("k").alias("blocked"),
                            F.lit(0.0).alias("bound"), F.lit(False).alias("bad"))
    placed = hosts.select("*", registered_domain(F.col("host"), suffixes).alias("domain"),
                          suffix(F.col("host"), suffixes).alias("suffix"))
    counted = [F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("members")]
    domains = keep(placed.groupBy("suffix", "domain").agg(*counted), "host-domains")
    ends = keep(domains.drop("members").groupBy("suffix").agg(*counted), "host-suffixes")
    parent = [F.col("n").alias("parent_n"), F.col("k").alias("parent_k"), F.col("members")]

    root = top["k"] / top["n"]
    s1 = _strength(ends.withColumn("parent_n", F.lit(top["n"])).withColumn("parent_k", F.lit(top["k"])))
    s2 = _strength(_join_uneven(domains.drop("members"), ends.select("suffix", *parent), ["suffix"], "members"))
    s3 = _strength(_join_uneven(placed.select("suffix", "domain", "n", "k"),
                                domains.select("suffix", "domain", *parent), ["suffix", "domain"], "members"))

    ends = ends.select("suffix", "members", ((F.col("k") + s1 * root) / (F.col("n") + s1)).alias("above"))
    domains = keep(_join_uneven(domains.withColumnRenamed("members", "hosts"), ends, ["suffix"], "members")
                   .select("suffix", "domain", F.col("hosts").alias("members"),
                           ((F.col("k") + s2 * F.col("above")) / (F.col("n") + s2)).alias("prior")), "host-priors")
    a, b = F.col("k") + s3 * F.col("prior"), (F.col("n") - F.col("k")) + s3 * (1 - F.col("prior"))
    judged = (_join_uneven(placed, domains, ["suffix", "domain"], "members")
              .withColumn("a", a).withColumn("b", b).withColumn("size", F.col("a") + F.col("b")))
    mean = F.col("a") / F.col("size")
    deviation = F.sqrt(mean * (F.col("b") / F.col("size")) / (F.col("size") + 1))
    return (judged.withColumn("bound", mean - z * deviation)
            .select("host", *others, F.col("n").alias("labelled"), F.col("k").alias("blocked"), "bound",
                    (F.col("bound") >= block_at).alias("bad")))


def judge_pages(pages: DataFrame, rules: list[Rule], outcome: Column | None = None, block_at: float = BLOCK_AT,
                z: float = Z, suffixes: tuple[str, ...] = SUFFIXES, hot_share: int = HOT_SHARE) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the host's record for every row of (page_id, url).

    ``outcome`` is a Boolean column over the rows of ``pages`` (true: a bad page, null: not
    labelled); by default the verdict of the rule that fits the page.
    """
    label = F.col("ruled") if outcome is None else F.col("outcome")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), url_host(F.col("url")).alias("host"),
                         url_path(F.col("url")).alias("path"),
                         (F.lit(None) if outcome is None else outcome).cast("boolean").alias("outcome"))
    named = with_rule(named, rules).withColumn("label", label).drop("outcome")
    hosts = keep(named.groupBy("host").agg(F.count("*").alias("pages"), F.count("label").alias("n"),
                                           F.count_if("label").alias("k")), "host-outcomes")
    reputations = keep(host_reputations(hosts, block_at, z, suffixes), "host-reputations")
    joined = _join_uneven(named.drop("label"), reputations, ["host"], "pages", hot_share)
    blocks = F.coalesce("ruled", "bad")
    return joined.select("page_id", "host", "path", "rule",
                         F.when(blocks, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
                         "labelled", "blocked", "bound")


def allowed_pages(pages: DataFrame, rules: list[Rule], **options) -> DataFrame:
    """The judged rows whose verdict is allow."""
    return judge_pages(pages, rules, **options).filter("verdict = 'allow'")
