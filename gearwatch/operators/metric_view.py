"""M0: metric views - named dimensions and measures, evaluated at the query's grain.

A measure is an aggregate SQL expression (as in a metric-view definition) and
is always recomputed from the source rows at whatever grain the query asks
for: any subset of the dimensions, including none (grand total).  Stored
ratios are never averaged.

All measures of one query go into a single ``agg``: one scan, one shuffle
(map-side partial aggregation), and Catalyst computes repeated
sub-expressions such as the same ``COUNT(1) FILTER (...)`` only once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..sources.catalog import publish_view, with_comments


@dataclass
class MetricView:
    name: str
    source: DataFrame
    dimensions: dict[str, str]
    measures: dict[str, str]
    comment: str = ""
    comments: dict[str, str] = field(default_factory=dict)

    def query(self, dims=(), measures=None, where: str | Column | None = None,
              having: str | Column | None = None, order_by=None, limit: int | None = None,
              decimals_as_double: bool = True) -> DataFrame:
        """``SELECT dims, MEASURE(m)... FROM view [WHERE] GROUP BY dims [HAVING] [ORDER] [LIMIT]``.

        ``where`` filters source rows (before aggregation); ``having`` filters
        measure values.  Exact decimal ratios are returned as DOUBLE.
        """
        measures = list(measures or self.measures)
        unknown = [d for d in dims if d not in self.dimensions] + [m for m in measures if m not in self.measures]
        if unknown:
            raise KeyError(f"{self.name}: unknown dimension/measure {unknown}")
        src = self.source
        if where is not None:
            src = src.where(where)
        keys = [F.expr(self.dimensions[d]).alias(d) for d in dims]
        aggs = [F.expr(self.measures[m]).alias(m) for m in measures]
        out = src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)
        if decimals_as_double:
            out = out.select(*[F.col(f.name).cast("double").alias(f.name)
                               if isinstance(f.dataType, DecimalType) else F.col(f.name)
                               for f in out.schema.fields])
        if having is not None:
            out = out.where(having)
        if order_by is not None:
            out = out.orderBy(*(order_by if isinstance(order_by, (list, tuple)) else [order_by]))
        if limit is not None:
            out = out.limit(limit)
        return out

    def combine(self, other: "MetricView", name: str | None = None) -> "MetricView":
        """One view with the measures of both, when they share source and dimensions.

        Lets a query that needs measures of two views over the same table
        (e.g. OEE and anomaly rate per equipment) scan it once, in one
        aggregate, instead of aggregating twice and joining the results.
        """
        if not self.source.sameSemantics(other.source):
            raise ValueError(f"{self.name} and {other.name} have different sources")
        for d in set(self.dimensions) & set(other.dimensions):
            if self.dimensions[d] != other.dimensions[d]:
                raise ValueError(f"dimension {d} differs between {self.name} and {other.name}")
        for m in set(self.measures) & set(other.measures):
            if self.measures[m] != other.measures[m]:
                raise ValueError(f"measure {m} differs between {self.name} and {other.name}")
        return MetricView(name or f"{self.name}+{other.name}", self.source,
                          {**self.dimensions, **other.dimensions}, {**self.measures, **other.measures},
                          comments={**self.comments, **other.comments})

    def publish(self, spark, name: str, dims=(), measures=None) -> str:
        """Expose one grain of the view to SQL users as a temp view (S11), its columns described."""
        return publish_view(spark, name, with_comments(self.query(dims, measures), self.comments))

    def describe(self) -> list[tuple[str, str, str, str]]:
        """(view, kind, name, comment) rows for the data dictionary."""
        rows = [(self.name, "view", self.name, self.comment)]
        rows += [(self.name, "dimension", d, self.comments.get(d, "")) for d in self.dimensions]
        rows += [(self.name, "measure", m, self.comments.get(m, "")) for m in self.measures]
        return rows
