"""URL verdicts by rules, and by trust and distrust that spread over links between hosts.

Rules name a host, with its subdomains, and the beginning of a path; the longest that fits decides. For other URLs the
host decides: personalised PageRank carries trust from hosts that rules allow along their links, and distrust from hosts
that rules block against the links, to those that point at them.

A host's seed is the part of its pages that rules allow (or block), so scores are in units of one wholly allowed or
blocked host. Trust adds up over all that link to a host, and distrust is divided among them, so either follows a host's
fame. Verdicts compare the same walks as seen from the host. Its leaning is distrust carried against the links by the part
of its own links that lead to each other host: how much of a personalised PageRank from there meets blocked hosts. Its
backing is trust carried along the links by the part of the links to it that come from each other host: the same against
the links, for allowed hosts. Hosts that link to nothing but a blocked host lean by the damping, be they two or a million,
and those that only wholly allowed hosts link to are backed by the damping, be these one or a million.
A host is blocked where its leaning reaches the threshold and its backing is no greater (a tie, up to the tolerance, is
decided by the host's own links); hosts without evidence are allowed.
"""

from __future__ import annotations

import functools
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import HOT_PARTS, attach
from evenkeel.staging import stage

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 1e-4
KINDS = ("trust", "backing", "distrust", "leaning")
ROUNDS = 50

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str) -> Column:
    return _lower(F.coalesce(F.regexp_extract(F.col(url), _URL, 1), F.lit("")))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and what it says, both null if none does. Of equal rules, a block wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, pattern in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        name, slash, rest = pattern.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst, links)``: how many links with a host of their own lead from one host to another."""
    found = pages.select(
        host_of(url).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), 1)).alias("dst")
    )
    between = found.select("src", _lower(F.col("dst")).alias("dst")).where(
        (F.col("src") != F.col("dst")) & (F.col("src") != "")
    )
    return between.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def _along(host: Column) -> Column:
    return F.concat(F.lit("along "), host)


def _against(host: Column) -> Column:
    return F.concat(F.lit("against "), host)


def host_edges(links: DataFrame) -> DataFrame:
    """``(node, to, divided, shared, hot)``: every link between hosts in both directions, a node being a host and a direction.

    ``divided`` is the link's part of all that leave ``node``, ``shared`` its part of all that reach ``to``; ``hot`` marks
    nodes that a thousandth of the rows leave, of which there are a thousand at most.
    """
    src, dst = F.col("src"), F.col("dst")
    both = stage(
        links.select(_along(src).alias("node"), _along(dst).alias("to"), "links").unionByName(
            links.select(_against(dst).alias("node"), _against(src).alias("to"), "links")
        ),
        "host-links",
    )
    total = both.count()
    hot = (F.col("n") * HOT_PARTS >= total).alias("hot")
    for end, all_links, more in (("node", "leaving", [hot]), ("to", "reaching", [])):
        sums = stage(both.groupBy(end).agg(F.count(F.lit(1)).alias("n"), F.sum("links").alias(all_links)), "host-sums")
        joined = attach(both, sums, end, "n", total, keep_copies=True)
        both = stage(joined.select(*both.columns, all_links, *more), "host-links")
    part = lambda name: F.col("links") / F.col(name)
    return both.select("node", "to", part("leaving").alias("divided"), part("reaching").alias("shared"), "hot")


def spread(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> DataFrame:
    """``(node, divided, shared)``: seeds and what reaches a node from them, by either part of ``host_edges``.

    ``seeds (node, seed)``. What a node has flows on, damped, until a round moves less than ``tolerance`` of the seeds
    by ``divided`` parts, and to no node more than ``tolerance`` by ``shared`` ones (or ``rounds`` are over). What nodes
    without links have flows nowhere. Each round is written, and only one total of it comes to the driver. What hot nodes
    have, a thousand rows at most, is broadcast to their edges.
    """
    seed = F.col("seed")
    flow = stage(seeds.where(seed > 0).select("node", seed.alias("score"), seed.alias("share")), "seeds")
    moving = F.coalesce(F.sum("score"), F.lit(0.0)), F.coalesce(F.max("share"), F.lit(0.0))
    mass = flow.agg(*moving).first()[0]
    hot_nodes = stage(edges.where("hot").select("node").distinct(), "hot-nodes")
    walked = [flow]
    for _ in range(rounds if mass else 0):
        of_hot = flow.join(F.broadcast(hot_nodes), "node")
        moved = edges.where(~F.col("hot")).join(flow, "node").unionByName(
            edges.where("hot").join(F.broadcast(of_hot), "node")
        )
        flow = stage(
            moved.groupBy(F.col("to").alias("node")).agg(
                F.sum(F.col("score") * F.col("divided") * damping).alias("score"),
                F.sum(F.col("share") * F.col("shared") * damping).alias("share"),
            ),
            "flow",
        )
        total, most = flow.agg(*moving).first()
        if total <= tolerance * mass and most <= tolerance:
            break
        walked.append(flow)
    every = functools.reduce(DataFrame.unionByName, walked)
    return every.groupBy("node").agg(F.sum("score").alias("divided"), F.sum("share").alias("shared"))


def host_scores(
    hosts: DataFrame, links: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, **settings
) -> DataFrame:
    """``(host, copies, trust, backing, distrust, leaning)`` for ``hosts (host, copies, allowed, blocked)`` and all that
    they link to."""
    _, of_root = rule_of(F.col("host"), F.lit("/"), rules)
    linked = links.select(F.col("dst").alias("host")).distinct().join(hosts, "host", "left_anti")
    uncrawled = linked.select("host", F.lit(0).cast("long").alias("copies"), *[
        F.coalesce((of_root == v).cast("double"), F.lit(0.0)).alias(n) for n, v in (
            ("allowed", "allow"), ("blocked", "block")
        )
    ])
    nodes = stage(hosts.unionByName(uncrawled), "hosts")
    host = F.col("host")
    seeds = nodes.select(F.explode(F.create_map(_along(host), "allowed", _against(host), "blocked")).alias("node", "seed"))
    scores = spread(stage(host_edges(links), "host-edges"), seeds, **settings)
    along = F.col("node").startswith("along ")
    named = {"trust": (along, "divided"), "backing": (along, "shared"),
             "distrust": (~along, "divided"), "leaning": (~along, "shared")}
    wide = scores.groupBy(F.substring_index("node", " ", -1).alias("host")).agg(
        *[F.sum(F.when(way, F.col(part)).otherwise(0.0)).alias(k) for k, (way, part) in named.items()]
    )
    return nodes.select("host", "copies").join(wide, "host", "left").fillna(0.0, [*KINDS])


def judge(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    threshold: float = THRESHOLD,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    **settings,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, backing, distrust, leaning)`` per page.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and no graph, and is allowed. Null html
    has no links. Null and repeated ids stay. Extra columns are left out. ``settings`` as for ``spread``.
    """
    links = stage(host_links(pages, url, html), "links")
    placed = pages.select(
        F.col(key).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = stage(placed.withColumns({"rule": rule, "said": said}), "judged")
    share = lambda v: F.avg(F.coalesce(F.col("said") == v, F.lit(False)).cast("double"))
    hosts = rows.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("copies"), share("allow").alias("allowed"), share("block").alias("blocked")
    )
    scores = stage(host_scores(hosts, links, rules, **settings), "host-scores")
    empty = rows.sparkSession.createDataFrame([("", rows.where(F.col("host") == "").count(), *[0.0] * len(KINDS))], scores.schema)
    judged = attach(rows, scores.unionByName(empty), "host", "copies", rows.count())
    margin = settings.get("tolerance", TOLERANCE)
    distrusted = (F.col("leaning") >= threshold) & (F.col("leaning") >= F.col("backing") - margin)
    verdict = F.coalesce(F.col("said"), F.when(distrusted, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), *KINDS)
