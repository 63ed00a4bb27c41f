"""Measures under a filter context.

Calendar and minutes, whose sizes have a bound, are broadcast and give facts
their labels at once.  If one other foreign key remains, facts are added up per
key, which the map side does before any shuffle, and only totals meet the
dimension.  With several keys hardly two facts share all of them, so facts meet
these dimensions as they are.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import a_year_later, date_title, key_date
from salesmart.functions.numbers import growth, safe_divide
from salesmart.operators.scalar import beside
from salesmart.plans.facts import MONTH
from salesmart.workspace import settle

AMOUNT, QTY = "TotalSalesAmount", "TotalQuantity"
PRIOR_AMOUNT, PRIOR_QTY = "SalesPriorPeriod", "QuantityPriorPeriod"

# Table -> (fact foreign key, key in the table).
LINKS = {
    "DimDate": ("FK_Date", "SK_Date"),
    "DimTime": ("FK_Time", "SK_Time"),
    "DimProduct": ("FK_Product", "SK_Product"),
    "DimPharmacy": ("FK_Pharmacy", "SK_Pharmacy"),
    "DimLocation": ("FK_Location", "SK_Location"),
    "DimOperator": ("FK_Operator", "SK_Operator"),
    "DimPOS": ("FK_POS", "SK_POS"),
    # Filters both ways through DimPharmacy.
    "PharmacySegmentation": ("FK_Pharmacy", "PharmacyID"),
}
# The ninth link, DateSlicer to DimDate on FullDate, is the context's ``slicer``.

#: Tables of bounded size: a row per day of a calendar of checked length, and 1,440 minutes.
BOUNDED = ("DimDate", "DimTime")


@dataclass(frozen=True)
class FilterContext:
    """What a report page has selected.

    ``after`` and ``without`` are the report-wide date filter, ``slicer`` is a
    half-open date range, ``keep``/``drop`` map (table, column) to values.
    """

    after: dt.date | None = None
    without: tuple[dt.date, ...] = ()
    slicer: tuple[dt.date, dt.date] | None = None
    keep: dict[tuple[str, str], tuple] = field(default_factory=dict)
    drop: dict[tuple[str, str], tuple] = field(default_factory=dict)

    def within(self, first: dt.date, end: dt.date) -> FilterContext:
        return replace(self, slicer=(first, end))

    def selecting(self, table: str, column: str, *values) -> FilterContext:
        return replace(self, keep={**self.keep, (table, column): values})

    def excluding(self, table: str, column: str, *values) -> FilterContext:
        return replace(self, drop={**self.drop, (table, column): values})

    @property
    def tables(self) -> list[str]:
        return sorted({t for t, _ in (*self.keep, *self.drop)})

    @property
    def limits_dates(self) -> bool:
        return bool(self.after or self.without or self.slicer or "DimDate" in self.tables)

    def on(self, table: str) -> Column:
        """Condition that the selections put on one table."""
        condition = F.lit(True)
        for (t, c), values in self.keep.items():
            if t == table:
                condition = condition & F.col(c).isin(*values)
        for (t, c), values in self.drop.items():
            if t == table:
                condition = condition & (F.col(c).isNull() | ~F.col(c).isin(*values))
        return condition

    def dates(self) -> Column:
        d = F.col("FullDate")
        condition = self.on("DimDate")
        if self.after:
            condition = condition & (d > F.lit(self.after))
        if self.without:
            condition = condition & ~d.isin(*self.without)
        if self.slicer:
            condition = condition & self.sliced()
        return condition

    def sliced(self) -> Column:
        if not self.slicer:
            return F.lit(True)
        d = F.col("FullDate")
        return (d >= F.lit(self.slicer[0])) & (d < F.lit(self.slicer[1]))

    def span(self, years_back: int = 0) -> tuple[dt.date | None, dt.date | None]:
        """First and last date that can matter, for partition and row-group pruning."""
        first = [self.after + dt.timedelta(days=1)] if self.after else []
        first += [self.slicer[0]] if self.slicer else []
        low = max(first) if first else None
        high = self.slicer[1] - dt.timedelta(days=1) if self.slicer else None
        if low and years_back:
            year = low.year - years_back
            low = dt.date(year, low.month, min(low.day, 28) if low.month == 2 else low.day)
        return low, high


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


@dataclass(frozen=True)
class Mart:
    """The star: sales facts and the tables linked to them."""

    facts: DataFrame
    tables: dict[str, DataFrame]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def pruned(facts: DataFrame, low: dt.date | None, high: dt.date | None) -> DataFrame:
    """Constant bounds on everything that follows the sale date, so that they reach the scan."""
    stamp = "SourceSaleDateTime"
    if low:
        facts = facts.filter(F.col("FK_Date") >= F.lit(_key(low)))
        if stamp in facts.columns:
            facts = facts.filter(F.col(stamp) >= F.lit(low).cast("timestamp_ntz"))
        if MONTH in facts.columns:
            facts = facts.filter(F.col(MONTH) >= F.lit(_key(low) // 100))
    if high:
        facts = facts.filter(F.col("FK_Date") <= F.lit(_key(high)))
        if stamp in facts.columns:
            facts = facts.filter(F.col(stamp) < F.lit(high + dt.timedelta(days=1)).cast("timestamp_ntz"))
        if MONTH in facts.columns:
            facts = facts.filter(F.col(MONTH) <= F.lit(_key(high) // 100))
    return facts


def visible_dates(mart: Mart, ctx: FilterContext, columns: tuple[str, ...] = ()) -> DataFrame:
    """The calendar rows in context.  One row per day, so it is always small enough to broadcast."""
    return mart["DimDate"].filter(ctx.dates()).select("SK_Date", "FullDate", *columns)


def _month_of(day: Column) -> Column:
    return F.floor(day / 100).cast("int")


def _on_days(facts: DataFrame, days: DataFrame, how: str = "inner") -> DataFrame:
    """Facts with the columns of their day.

    The storage month is part of the condition, so that the months of the days
    that are left, whatever was selected on the calendar, prune the scan.
    """
    on = F.col("FK_Date") == F.col("SK_Date")
    if MONTH in facts.columns:
        days = days.withColumn("_month", _month_of(F.col("SK_Date")))
        on = on & (F.col(MONTH) == F.col("_month"))
    return facts.join(F.broadcast(days), on, how).drop("_month")


def _in_months(mart: Mart, ctx: FilterContext, facts: DataFrame) -> DataFrame:
    """Facts of the visible months and of those a year before; the calendar bounds how many there are."""
    if MONTH not in facts.columns or not ctx.limits_dates:
        return facts
    month = _month_of(F.col("SK_Date"))
    months = visible_dates(mart, ctx).select(F.explode(F.array(month, month - 100)).alias("_month")).distinct()
    return facts.join(F.broadcast(months), F.col(MONTH) == F.col("_month"), "left_semi")


def _labels(by: tuple[tuple[str, str], ...], table: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(c for t, c in by if t == table))


def _selected(df: DataFrame, mart: Mart, ctx: FilterContext) -> DataFrame:
    """Keep rows whose keys the dimension selections leave visible."""
    for table in ctx.tables:
        if table in BOUNDED:
            continue
        fk, key = LINKS[table]
        keys = mart[table].filter(ctx.on(table)).select(F.col(key).alias("_key"))
        df = df.join(keys, F.col(fk) == F.col("_key"), "left_semi")
    return df


def _labelled(df: DataFrame, mart: Mart, by: tuple[tuple[str, str], ...]) -> DataFrame:
    """Left joins, so rows without a dimension row end up under a blank label."""
    for table in dict.fromkeys(t for t, _ in by):
        columns = _labels(by, table)
        if table in BOUNDED:
            continue
        fk, key = LINKS[table]
        side = mart[table].select(F.col(key).alias(f"_{table}"), *columns)
        df = df.join(side, F.col(fk) == F.col(f"_{table}"), "left")
    return df


def _timed(facts: DataFrame, mart: Mart, ctx: FilterContext, by: tuple[tuple[str, str], ...]) -> DataFrame:
    """Facts with the labels of their minute, and only those of the minutes selected."""
    labels, chosen = _labels(by, "DimTime"), "DimTime" in ctx.tables
    if not (labels or chosen):
        return facts
    minutes = mart["DimTime"].filter(ctx.on("DimTime")).select("SK_Time", *labels)
    return facts.join(F.broadcast(minutes), F.col("FK_Time") == F.col("SK_Time"), "inner" if chosen else "left")


def _foreign_keys(ctx: FilterContext, by: tuple[tuple[str, str], ...]) -> list[str]:
    tables = [t for t, _ in by] + ctx.tables
    return list(dict.fromkeys(LINKS[t][0] for t in tables if t not in BOUNDED))


def _sums(*pairs: tuple[str, str]) -> list[Column]:
    return [F.sum(F.col(c)).alias(out) for c, out in pairs]


def sales(mart: Mart, ctx: FilterContext, by: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Total amount and quantity in context, by (table, column) labels."""
    keys = _foreign_keys(ctx, by)
    labels = _labels(by, "DimDate")
    facts = _timed(pruned(mart.facts, *ctx.span()), mart, ctx, by)
    if ctx.limits_dates or labels:
        days = visible_dates(mart, ctx, labels).drop(*({"FullDate"} - set(labels)))
        how = "inner" if ctx.limits_dates else "left"
        facts = _on_days(facts, days, how)
    labels += _labels(by, "DimTime")
    amount, qty = F.col("Amount").cast("decimal(28,2)"), F.col("Qty").cast("bigint")
    if len(keys) > 1:
        rows = facts.select(*keys, *labels, amount.alias(AMOUNT), qty.alias(QTY))
    else:
        rows = facts.groupBy(*keys, *labels).agg(F.sum("Amount").alias(AMOUNT), F.sum(qty).alias(QTY))
    shown = _labelled(_selected(rows, mart, ctx), mart, by)
    return shown.groupBy(*(c for _, c in by)).agg(*_sums((AMOUNT, AMOUNT), (QTY, QTY)))


def sales_with_prior(mart: Mart, ctx: FilterContext, by: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Current totals and those of the same dates a year before, from one scan.

    Daily totals are laid out twice, once on their own date and once a year
    later, and matched to the visible dates.  The shift replaces every other
    date filter, so prior days need not lie inside the slicer.
    """
    times = _labels(by, "DimTime")
    keys = [*_foreign_keys(ctx, by), *times]
    labels = _labels(by, "DimDate")
    facts = _timed(_in_months(mart, ctx, pruned(mart.facts, *ctx.span(years_back=1))), mart, ctx, by)
    daily = facts.groupBy("FK_Date", *keys).agg(
        F.sum("Amount").alias("a"), F.sum(F.col("Qty").cast("bigint")).alias("q")
    )
    day = key_date(F.col("FK_Date"))
    none_a, none_q = F.lit(None).cast("decimal(28,2)"), F.lit(None).cast("bigint")
    amount = F.col("a").cast("decimal(28,2)")

    def laid_out(on: Column, a: Column, q: Column, pa: Column, pq: Column) -> Column:
        return F.struct(
            on.alias("_day"), a.alias(AMOUNT), q.alias(QTY), pa.alias(PRIOR_AMOUNT), pq.alias(PRIOR_QTY)
        )

    both = daily.select(
        *keys,
        F.inline(
            F.array(
                laid_out(day, amount, F.col("q"), none_a, none_q),
                laid_out(a_year_later(day), none_a, none_q, amount, F.col("q")),
            )
        ),
    )
    days = F.broadcast(visible_dates(mart, ctx, tuple(c for c in labels if c != "FullDate")).drop("SK_Date"))
    measures = [(c, c) for c in (AMOUNT, QTY, PRIOR_AMOUNT, PRIOR_QTY)]
    totals = both.join(days, F.col("_day") == F.col("FullDate")).groupBy(*keys, *labels).agg(*_sums(*measures))
    shown = _labelled(_selected(totals, mart, ctx), mart, by)
    return shown.groupBy(*(c for _, c in by)).agg(*_sums(*measures)) if keys else totals


def with_growth(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "SalesGrowthAbsolute": growth(F.col(AMOUNT), F.col(PRIOR_AMOUNT)),
            "QuantityGrowthAbsolute": growth(F.col(QTY), F.col(PRIOR_QTY)),
        }
    )


def with_year_over_year(df: DataFrame) -> DataFrame:
    change = growth(F.col(AMOUNT), F.col(PRIOR_AMOUNT))
    return df.withColumn("SalesYoYPct", safe_divide(change.cast("double"), F.col(PRIOR_AMOUNT).cast("double")))


def slicer_range(mart: Mart, ctx: FilterContext) -> DataFrame:
    """First and last date of the slicer's own selection; other filters do not reach it."""
    return mart["DateSlicer"].filter(ctx.sliced()).agg(F.min("FullDate").alias("lo"), F.max("FullDate").alias("hi"))


def denominator(mart: Mart, ctx: FilterContext) -> DataFrame:
    """All sales between the slicer's first and last date, every other filter removed."""
    days = beside(mart["DimDate"], slicer_range(mart, ctx)).filter(F.col("FullDate").between(F.col("lo"), F.col("hi")))
    bounds = FilterContext(slicer=ctx.slicer).span()
    facts = pruned(mart.facts, *bounds).join(
        F.broadcast(days.select("SK_Date")), F.col("FK_Date") == F.col("SK_Date"), "left_semi"
    )
    return facts.agg(F.sum("Amount").alias("AllAmount"), F.sum(F.col("Qty").cast("bigint")).alias("AllQuantity"))


def with_shares(df: DataFrame, whole: DataFrame) -> DataFrame:
    return beside(df, whole).withColumns(
        {
            "SalesAmountShare": safe_divide(F.col(AMOUNT).cast("double"), F.col("AllAmount").cast("double")),
            "QuantityShare": safe_divide(F.col(QTY).cast("double"), F.col("AllQuantity").cast("double")),
        }
    ).drop("AllAmount", "AllQuantity")


_BOTH = (AMOUNT, QTY, "AllAmount", "AllQuantity")


def _both_totals(mart: Mart, ctx: FilterContext, by: tuple[tuple[str, str], ...]) -> DataFrame:
    """From one scan, per foreign key and date label: sums in context, and over the whole range of the slicer.

    The calendar says for each day whether it is in context, in the range, or both.
    """
    labels = _labels(by, "DimDate")
    in_slicer = F.col("FullDate").between(F.col("lo"), F.col("hi"))
    days = (
        beside(mart["DimDate"], slicer_range(mart, ctx))
        .withColumns({"_in": F.coalesce(ctx.dates(), F.lit(False)), "_all": in_slicer})
        .filter(F.col("_in") | F.col("_all"))
        .select("SK_Date", "_in", "_all", *labels)
    )
    facts = pruned(mart.facts, *FilterContext(slicer=ctx.slicer).span())
    facts = _on_days(facts, days)
    shown = F.col("_in")
    if times := [t for t in ("DimTime",) if t in (*ctx.tables, *(t for t, _ in by))]:
        minutes = mart[times[0]].select("SK_Time", *_labels(by, "DimTime"), ctx.on("DimTime").alias("_minute"))
        facts = facts.join(F.broadcast(minutes), F.col("FK_Time") == F.col("SK_Time"), "left")
        shown = shown & (F.col("_minute") if "DimTime" in ctx.tables else F.lit(True))
    amount, qty = F.col("Amount"), F.col("Qty").cast("bigint")
    sums = [F.sum(F.when(shown, amount)), F.sum(F.when(shown, qty)), F.sum(F.when(F.col("_all"), amount)), F.sum(F.when(F.col("_all"), qty))]
    return facts.groupBy(*_foreign_keys(ctx, by), *labels, *_labels(by, "DimTime")).agg(*(x.alias(c) for x, c in zip(sums, _BOTH)))


def _only_selected(totals: DataFrame, mart: Mart, ctx: FilterContext) -> DataFrame:
    """Blank the sums in context where a selection leaves the key out; the sums over all stay."""
    chosen = F.lit(True)
    for n, table in enumerate(t for t in ctx.tables if t not in BOUNDED):
        fk, key = LINKS[table]
        keys = mart[table].filter(ctx.on(table)).select(F.col(key).alias(f"_key{n}")).distinct()
        totals = totals.join(keys, F.col(fk) == F.col(f"_key{n}"), "left")
        chosen = chosen & F.col(f"_key{n}").isNotNull()
    return totals.withColumns({c: F.when(chosen, F.col(c)) for c in (AMOUNT, QTY)})


def share_card(mart: Mart, ctx: FilterContext) -> DataFrame:
    """Totals and their shares as one row, numerator and denominator from the same scan."""
    one = _only_selected(_both_totals(mart, ctx, ()), mart, ctx).agg(*_sums(*((c, c) for c in _BOTH)))
    return one.select(
        AMOUNT, QTY,
        safe_divide(F.col(AMOUNT).cast("double"), F.col("AllAmount").cast("double")).alias("SalesAmountShare"),
        safe_divide(F.col(QTY).cast("double"), F.col("AllQuantity").cast("double")).alias("QuantityShare"),
    )


def shares(mart: Mart, ctx: FilterContext, by: tuple[tuple[str, str], ...]) -> DataFrame:
    """Totals by label and their shares of all sales in the slicer's range.

    The facts are read once; their totals per key are written, as both the
    rows and what they are divided by are made from them.
    """
    totals = settle(_both_totals(mart, ctx, by), "totals")
    whole = totals.agg(*_sums(("AllAmount", "AllAmount"), ("AllQuantity", "AllQuantity")))
    rows = _only_selected(totals, mart, ctx).filter(F.col(AMOUNT).isNotNull() | F.col(QTY).isNotNull())
    shown = _labelled(rows, mart, by).groupBy(*(c for _, c in by)).agg(*_sums((AMOUNT, AMOUNT), (QTY, QTY)))
    return with_shares(shown, whole)


def pharmacy_count(mart: Mart, ctx: FilterContext) -> DataFrame:
    """Pharmacies the selections leave visible, with or without sales."""
    dim = mart["DimPharmacy"].filter(ctx.on("DimPharmacy"))
    if "PharmacySegmentation" in ctx.tables:
        keys = mart["PharmacySegmentation"].filter(ctx.on("PharmacySegmentation")).select("PharmacyID")
        dim = dim.join(keys, F.col("SK_Pharmacy") == F.col("PharmacyID"), "left_semi")
    return dim.agg(F.count_distinct("SK_Pharmacy").alias("PharmacyCount"))


def period_title(mart: Mart, ctx: FilterContext) -> DataFrame:
    one = visible_dates(mart, ctx).agg(F.min("FullDate").alias("a"), F.max("FullDate").alias("b"))
    return one.select(date_title(F.col("a"), F.col("b")).alias("DynamicDateTitle"))
