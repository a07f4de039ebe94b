"""Screening view, its paged query, and the storage inventory rollup."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns a caller may sort by, and the page size bounds.
SORT_COLUMNS = (
    "ticker",
    "company_name",
    "eps_yoy_latest",
    "revenue_yoy_latest",
    "annual_eps_growth",
    "fundamental_as_of",
)
DEFAULT_LIMIT = 50
MAX_LIMIT = 200

FUNDAMENTALS = [
    "accepted_at", "fiscal_period_end", "eps_yoy_latest", "eps_yoy_prior",
    "revenue_yoy_latest", "revenue_yoy_prior", "annual_eps_growth",
]


def explorer_view(securities: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """Securities with their current fundamentals, where there are any."""
    f = fundamentals.select(
        "security_id",
        F.col("status").alias("fundamental_status"),
        F.col("as_of_date").alias("fundamental_as_of"),
        *FUNDAMENTALS,
    )
    s = securities.select("security_id", "ticker", "company_name", "sharia_compliance", "universe_snapshot_date")
    return s.join(f, "security_id", "left")


@dataclass(frozen=True)
class ExplorerRequest:
    """Filters, sort and page of one screening query.

    A page holds at most ``max_limit`` rows and an unknown sort column means the
    ticker; what was applied comes back with the rows.
    """

    q: str = ""
    compliance: str | None = None
    fundamental_status: str | None = None
    minimums: dict[str, float] = field(default_factory=dict)
    maximums: dict[str, float] = field(default_factory=dict)
    sort: str = "ticker"
    descending: bool = False
    page: int = 1
    limit: int | None = None
    max_limit: int = MAX_LIMIT

    @property
    def page_number(self) -> int:
        return max(self.page or 1, 1)

    @property
    def sort_column(self) -> str:
        return self.sort if self.sort in SORT_COLUMNS else "ticker"

    @property
    def page_size(self) -> int:
        return min(max(self.limit or DEFAULT_LIMIT, 1), self.max_limit)

    @property
    def offset(self) -> int:
        return (self.page_number - 1) * self.page_size


RANGE_COLUMNS = ("eps_yoy_latest", "revenue_yoy_latest", "annual_eps_growth")


def explorer_matches(view: DataFrame, request: ExplorerRequest) -> DataFrame:
    """All rows of the view that meet the request's filters."""
    test: Column = F.lit(True)
    q = request.q.strip()
    if q:
        # % and _ keep their wildcard meaning, as in the served query; a backslash has none
        q = q.replace("\\", "\\\\")
        test = test & (F.col("ticker").ilike(q.upper() + "%") | F.col("company_name").ilike("%" + q + "%"))
    if request.compliance:
        test = test & (F.col("sharia_compliance") == request.compliance.upper())
    if request.fundamental_status:
        test = test & (F.col("fundamental_status") == request.fundamental_status)
    for name in RANGE_COLUMNS:
        if name in request.minimums:
            test = test & (F.col(name) >= float(request.minimums[name]))
        if name in request.maximums:
            test = test & (F.col(name) <= float(request.maximums[name]))
    return view.filter(test)


def explorer_query(view: DataFrame, request: ExplorerRequest) -> DataFrame:
    """One page of matches in sort order, each row with the ``total`` of all matches and the page applied."""
    hits = explorer_matches(view, request)
    total = hits.agg(F.count("*")).scalar()
    key = F.col(request.sort_column)
    order = [key.desc() if request.descending else key.asc(), F.col("ticker").asc(), F.col("security_id").asc()]
    page = hits.orderBy(*order).offset(request.offset).limit(request.page_size)
    applied = {
        "page": F.lit(request.page_number),
        "limit": F.lit(request.page_size),
        "sort": F.lit(request.sort_column),
        "order": F.lit("desc" if request.descending else "asc"),
    }
    return page.withColumns({"total": total, **applied})


def prefix_rollup(inventory: DataFrame, depth: int | None = None) -> DataFrame:
    """Objects and bytes below every folder prefix of the object keys.

    ``depth`` keeps only prefixes of that many parts (a shorter key counts under
    itself); without it every folder of the tree is listed with its depth. Keys
    are counted per prefix on the map side, so a folder with most of the objects
    is no hot group.
    """
    parts = F.split(F.col("key"), "/")
    if depth is not None:
        head = F.array_join(F.slice(parts, 1, depth), "/")
        prefix = F.concat(head, F.when(F.size(parts) > 1, F.lit("/")).otherwise(F.lit("")))
        return inventory.groupBy(prefix.alias("prefix")).agg(
            F.count("*").alias("objects"), F.sum("size").alias("bytes")
        )
    folders = F.filter(parts, lambda p: p != "")
    # the folder list is reduced first: objects of one folder share all prefixes
    folder = (
        inventory.select(folders.alias("all"), "size")
        .select(F.slice("all", 1, F.greatest(F.size("all") - 1, F.lit(0))).alias("dir"), "size")
        .groupBy("dir")
        .agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))
    )
    levels = F.when(F.size("dir") > 0, F.sequence(F.lit(1), F.size("dir")))
    tree = folder.select(F.explode(levels).alias("depth"), "dir", "objects", "bytes").select(
        F.array_join(F.slice("dir", 1, F.col("depth")), "/").alias("path"), "depth", "objects", "bytes"
    )
    return tree.groupBy("path", "depth").agg(F.sum("objects").alias("objects"), F.sum("bytes").alias("bytes"))


def inventory_totals(inventory: DataFrame, protected: tuple[str, ...] = ()) -> DataFrame:
    """One row: all objects and bytes, and those under protected prefixes."""
    safe = F.lit(False)
    for p in protected:
        safe = safe | F.col("key").startswith(p)
    zero = F.lit(0)
    return inventory.agg(
        F.count("*").alias("total_objects"),
        F.coalesce(F.sum("size"), zero).alias("total_bytes"),
        F.count_if(safe).alias("protected_objects"),
        F.coalesce(F.sum(F.when(safe, F.col("size"))), zero).alias("protected_bytes"),
    )


def largest_first(rollup: DataFrame) -> DataFrame:
    name = "prefix" if "prefix" in rollup.columns else "path"
    return rollup.orderBy(F.col("bytes").desc(), F.col(name).asc())
