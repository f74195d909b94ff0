"""Chains of pages: every page names the one that follows it.

Pages of all chains are followed at once by doubling: what is known of the pages within 2^k steps, and
where each page leads after 2^k steps, gives both for 2^(k+1). So a chain of a million pages takes
some twenty rounds, each a few joins and written to the shared folder. Pages are numbered first, so
that the rounds move two numbers a page whatever chains and tokens look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import quoted
from tallybook.session import materialise

FIRST = ""
"""The token that the first page of a chain is asked for with; NULL counts as it."""


def _token(name: str):
    return F.coalesce(quoted(name).cast("string"), F.lit(FIRST))


def _links(pages: DataFrame, chain: Sequence[str], token: str, next_token: str) -> DataFrame:
    """``chain, page, next`` (NULL at the end of a chain), each link once; ``chain`` is a struct."""
    named = F.struct(*[quoted(c).alias(c) for c in chain]).alias("chain")
    following = F.nullif(quoted(next_token).cast("string"), F.lit(FIRST))
    return pages.select(named, _token(token).alias("page"), following.alias("next")).distinct()


def _same_chain(a, b):
    return a["chain"].eqNullSafe(b["chain"])


def page_positions(pages: DataFrame, chain: Sequence[str], token: str, next_token: str) -> DataFrame:
    """``chain, page, position``: the pages that are reached from the first, and the fewest steps to each.

    ``chain`` (a struct of the columns named) tells chains apart; NULLs in it are equal. The first page's
    token is NULL or empty. A page served with two different next tokens leads to both. Loops end
    where a page would be reached again. Pages that nothing leads to don't appear.
    """
    links, _ = materialise(_links(pages, chain, token, next_token), "chain-links")
    named = links.select("chain", "page").distinct().withColumn("id", F.monotonically_increasing_id())
    here, n_pages = materialise(named, "chain-pages")  # written, so that a page keeps its number
    onward = links.filter("next IS NOT NULL").join(
        here.select(F.col("chain").alias("c"), F.col("page").alias("p"), "id"), _on("chain", "page", "c", "p")
    )
    onward = onward.select("chain", F.col("next").alias("to"), F.col("id").alias("from"))
    jumps = onward.join(here, (F.col("to") == F.col("page")) & onward["chain"].eqNullSafe(here["chain"]))
    jumps, n_jumps = materialise(jumps.select(F.col("from"), F.col("id").alias("next")), "chain-jumps")
    # Where every page leads to one at most, so does every longer jump, and none is there twice.
    single = jumps.select("from").distinct().count() == n_jumps
    start = here.filter(F.col("page") == FIRST).select("id", F.lit(0).cast("long").alias("position"))
    known, n_known = materialise(start, "chain-known")
    steps = 1
    while n_jumps:
        led = known.join(jumps, F.col("id") == F.col("from"))
        led = led.select(F.col("next").alias("id"), (F.col("position") + steps).alias("position"))
        before = n_known
        both = known.unionByName(led).groupBy("id").agg(F.min("position").alias("position"))
        known, n_known = materialise(both, "chain-known")
        if n_known in (before, n_pages):
            break
        second = jumps.select(F.col("from").alias("middle"), F.col("next").alias("then"))
        twice = jumps.join(second, F.col("next") == F.col("middle")).select("from", F.col("then").alias("next"))
        jumps, n_jumps = materialise(twice if single else twice.distinct(), "chain-jumps")
        steps *= 2
    return materialise(here.join(known, "id").select("chain", "page", "position"), "chain-positions")[0]


def _on(chain: str, page: str, other_chain: str, other_page: str):
    return F.col(chain).eqNullSafe(F.col(other_chain)) & (F.col(page) == F.col(other_page))


def page_faults(
    pages: DataFrame, chain: Sequence[str], token: str, next_token: str, positions: DataFrame | None = None
) -> DataFrame:
    """What is wrong with the chains: ``<chain columns>, kind, token, n``.

    ``lost``       a page that others lead to is not there; ``n`` links lead to it
    ``loop``       a page leads back to one that is reached before it, or to itself; ``token`` is the page led to
    ``repeated``   a page was served ``n`` times, more than once
    ``unreached``  a page is there ``n`` times that nothing leads to, as behind a lost one; a chain
                   without a first page has all its pages unreached
    """
    links = _links(pages, chain, token, next_token)
    if positions is None:
        positions = page_positions(pages, chain, token, next_token)
    named = F.struct(*[quoted(c).alias(c) for c in chain]).alias("chain")
    served = pages.groupBy(named, _token(token).alias("page")).agg(F.count(F.lit(1)).alias("n"))
    at = positions.withColumnsRenamed({"chain": "c", "page": "p", "position": "to"})
    there = served.select(F.col("chain").alias("c"), F.col("page").alias("p"))

    repeated = served.filter("n > 1").select("chain", F.lit("repeated").alias("kind"), F.col("page").alias("token"), "n")
    unreached = served.join(at, _on("chain", "page", "c", "p"), "left_anti")
    unreached = unreached.select("chain", F.lit("unreached").alias("kind"), F.col("page").alias("token"), "n")
    onward = links.filter("next IS NOT NULL")
    lost = onward.join(there, _on("chain", "next", "c", "p"), "left_anti")
    lost = lost.groupBy("chain", "next").agg(F.count(F.lit(1)).alias("n"))
    lost = lost.select("chain", F.lit("lost").alias("kind"), F.col("next").alias("token"), "n")
    placed = onward.join(positions.withColumnsRenamed({"chain": "d", "page": "q"}), _on("chain", "page", "d", "q"))
    loops = placed.join(at, _on("chain", "next", "c", "p")).filter("to <= position")
    loops = loops.groupBy("chain", "next").agg(F.count(F.lit(1)).alias("n"))
    loops = loops.select("chain", F.lit("loop").alias("kind"), F.col("next").alias("token"), "n")
    found = repeated.unionByName(unreached).unionByName(lost).unionByName(loops)
    return found.select("chain.*", "kind", "token", "n")


def in_page_order(pages: DataFrame, chain: Sequence[str], token: str, next_token: str) -> DataFrame:
    """``pages`` with ``page_position`` (0 for the first, NULL for unreached ones), each served page once.

    Pages served twice with the same content stay once; with different content all of them stay.
    """
    positions = page_positions(pages, chain, token, next_token)
    content = F.xxhash64(F.to_json(F.struct(*[quoted(c) for c in pages.columns])))
    distinct = pages.withColumn("_content", content).dropDuplicates([*chain, token, next_token, "_content"]).drop("_content")
    key = F.struct(*[quoted(c).alias(c) for c in chain])
    keyed = distinct.withColumns({"_chain": key, "_page": _token(token)})
    joined = keyed.join(positions, _on("_chain", "_page", "chain", "page"), "left")
    return joined.select(*[quoted(c) for c in pages.columns], F.col("position").alias("page_position"))
