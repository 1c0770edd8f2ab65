"""Page chains of landed histories (S6): each page once, in the order of its tokens, gaps reported.

A page was fetched with ``pageToken`` (null for the first page) and names its
successor by ``nextPageToken`` (null or empty at the end). Where a lander kept
no ``pageToken``, the page's number is its place and page n + 1 follows page n.
Pages may be landed twice, out of order, or be missing.

Places are joined, contents stay where they are: only pages that were landed
more than once cross the network. Chains are ranked by pointer jumping, in as
many rounds as the logarithm of the longest chain, so a workflow of any number
of pages is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators.sequence import ordinal
from tally.operators.timing import WF
from tally.session import land


def _place(token: str, page) -> F.Column:
    return F.coalesce(F.concat(F.lit("token "), F.nullif(F.col(token), F.lit(""))), F.concat(F.lit("page "), page.cast("string")))


def _placed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_place``, where a page stands, and ``_digest`` of its content."""
    if "pageToken" not in pages.columns:
        pages = pages.withColumn("pageToken", F.lit(None).cast("string"))
    number = F.coalesce(F.col("page"), F.lit(0))
    return pages.withColumns({"page": number, "_place": _place("pageToken", number),
                              "_digest": F.sha2(F.to_json(F.struct("history", "nextPageToken")), 256)})


def unique_pages(placed: DataFrame) -> DataFrame:
    """Each (place, content) of a workflow once. Pages landed a single time don't shuffle but to meet the short list of the others."""
    key = [WF, "_place", "_digest"]
    # By the digest's bytes first, by its text in the join: AQE may then split a much repeated page.
    several = (placed.groupBy(WF, "_place", F.unhex("_digest").alias("_bytes")).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
               .select(WF, "_place", F.lower(F.hex("_bytes")).alias("_digest"), F.lit(True).alias("_several")))
    marked = placed.join(several, key, "left")
    alone = marked.where("_several is null").drop("_several")
    return alone.unionByName(marked.where("_several").drop("_several").dropDuplicates(key))


def _ranked(places: DataFrame) -> DataFrame:
    """``places`` (workflow, _place, page, nextPageToken) with ``_root``, the place its chain begins at, and ``_rank`` in it."""
    following = F.filter(F.array(F.concat(F.lit("token "), F.nullif(F.col("nextPageToken"), F.lit(""))),
                                 F.concat(F.lit("page "), (F.col("page") + 1).cast("string"))), lambda x: x.isNotNull())
    before = places.select(WF, F.col("_place").alias("_before"), F.explode(following).alias("_place"))
    # Two contents at one place have one predecessor; one page may be named by its token and by its number.
    before = before.where(F.col("_before") != F.col("_place")).groupBy(WF, "_place").agg(F.min("_before").alias("_up"))
    state = land(places.select(WF, "_place").distinct().join(before, [WF, "_place"], "left").select(
        WF, "_place", F.coalesce("_up", "_place").alias("_root"), F.when(F.col("_up").isNull(), 0).otherwise(1).cast("long").alias("_rank")))
    n = state.count()
    while True:
        above = state.select(WF, F.col("_place").alias("_root"), F.col("_root").alias("_far"), F.col("_rank").alias("_more"))
        moved = land(state.join(above, [WF, "_root"]).select(
            WF, "_place", F.col("_far").alias("_root"), (F.col("_rank") + F.col("_more")).alias("_rank"), (F.col("_far") != F.col("_root")).alias("_moved")))
        # In a circle a page comes back to itself, or its rank passes the number of pages.
        circle = (F.col("_rank") > n) | ((F.col("_rank") > 0) & (F.col("_root") == F.col("_place")))
        still, round_ = moved.agg(F.max("_moved"), F.max(circle)).first()
        if round_:
            raise ValueError("page tokens go round in a circle")
        state = moved.drop("_moved")
        if not still:
            return places.join(state, [WF, "_place"])


def _slim(unique: DataFrame) -> DataFrame:
    return land(unique.select(WF, "_place", "_digest", "page", "nextPageToken"))


def _with_start(ranked: DataFrame) -> DataFrame:
    """``ranked`` with ``_from``, the landed number of the chain's first page."""
    roots = ranked.where(F.col("_place") == F.col("_root")).groupBy(WF, "_root").agg(F.min("page").alias("_from"))
    return ranked.join(roots, [WF, "_root"])


def chained_pages(pages: DataFrame) -> DataFrame:
    """``pages`` each once, ``page`` numbered from 0 in the order of the chain.

    Pages beyond a gap come after those before it, by the number that their
    chain's first page was landed with. All other columns pass unchanged.
    """
    unique = unique_pages(_placed(pages))
    order = ordinal(_with_start(_ranked(_slim(unique))), [WF], ["_from", "_root", "_rank", "_digest"], out="_no")
    numbers = order.select(WF, "_place", "_digest", F.col("_no").cast("int").alias("_no"))
    return unique.join(numbers, [WF, "_place", "_digest"]).withColumn("page", F.col("_no")).select(pages.columns)


def page_report(pages: DataFrame) -> DataFrame:
    """``workflow_id, landed, pages, duplicates, conflicts, gaps, complete`` of each workflow.

    ``conflicts``: places with more than one content. ``gaps``: places where
    pages are missing, within the chain or at its end, each run of missing pages once.
    """
    placed = land(_placed(pages).select(WF, "_place", "_digest", "page", "nextPageToken"))
    slim = placed.dropDuplicates([WF, "_place", "_digest"])
    ranked = land(_with_start(_ranked(slim)))
    landed = placed.groupBy(WF).agg(F.count(F.lit(1)).alias("landed"))
    places = ranked.groupBy(WF, "_place").agg(
        F.count(F.lit(1)).alias("_contents"), F.first("_root").alias("_root"), F.first("_from").alias("_from"),
        F.max(F.nullif(F.col("nextPageToken"), F.lit(""))).alias("_next"), F.max("page").alias("page"))
    # A page that names a successor which isn't there; a page other than the first that nothing leads to.
    leads = places.select(WF, F.col("_place").alias("_follower")).distinct()
    by_token = leads.withColumnRenamed("_follower", "_t").withColumn("_has_t", F.lit(True))
    by_page = leads.withColumnRenamed("_follower", "_p").withColumn("_has_p", F.lit(True))
    checked = (places.withColumns({"_t": F.concat(F.lit("token "), "_next"), "_p": F.concat(F.lit("page "), (F.col("page") + 1).cast("string"))})
               .join(by_token, [WF, "_t"], "left").join(by_page, [WF, "_p"], "left"))
    counts = checked.groupBy(WF).agg(
        F.sum("_contents").alias("pages"), F.sum((F.col("_contents") > 1).cast("long")).alias("conflicts"),
        F.sum((F.col("_next").isNotNull() & F.col("_has_t").isNull() & F.col("_has_p").isNull()).cast("long")).alias("_ends"),
        F.sum(((F.col("_place") == F.col("_root")) & (F.col("_place") != "page 0")).cast("long")).alias("_starts"))
    gaps = F.greatest("_ends", "_starts")
    return counts.join(landed, WF).select(
        WF, "landed", "pages", (F.col("landed") - F.col("pages")).alias("duplicates"), "conflicts", gaps.alias("gaps"),
        ((gaps == 0) & (F.col("conflicts") == 0)).alias("complete"))
