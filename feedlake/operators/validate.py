"""Facet checks on parsed messages: required, length and pattern rules of the feed schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.expressions import with_once
from feedlake.schemas import LOCATION_KINDS


@dataclass(frozen=True)
class Facet:
    """Length bounds, a pattern the whole text has to match, an upper bound of a number, or a real day."""

    shortest: int = 0
    longest: int | None = None
    pattern: str | None = None
    at_most: int | None = None
    day: bool = False

    def holds(self, text: Column) -> Column:
        checks = [F.length(text) >= self.shortest]
        if self.longest is not None:
            checks.append(F.length(text) <= self.longest)
        if self.pattern is not None:
            checks.append(text.rlike(f"\\A(?:{self.pattern})\\z"))
        if self.day:
            # Years beyond four digits are beyond the calendar of try_to_date; their pattern has to do.
            day = F.try_to_date(F.regexp_extract(text, r"\A([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), "yyyy-MM-dd")
            checks.append(day.isNotNull() | text.rlike(r"\A(-|[0-9]{5})"))
        if self.at_most is not None:
            number = text.try_cast("int")
            checks.append(F.coalesce((number >= 0) & (number <= self.at_most), F.lit(False)))
        met = checks[0]
        for check in checks[1:]:
            met = met & check
        return met


# Limits of the feed's simple types.
RID = Facet(longest=16)
UID = Facet(shortest=6, longest=6)
TRAIN_ID = Facet(shortest=4, longest=4, pattern="[0-9][A-Z][0-9][0-9]")
TOC = Facet(shortest=2, longest=2)
TIPLOC = Facet(shortest=1, longest=7)
PLATFORM = Facet(shortest=1, longest=3)
TRAIN_LENGTH = Facet(at_most=99)
ACTIVITY = Facet(shortest=2, longest=12, pattern=r"([A-Z0-9\- ][A-Z0-9\- ]){1,6}")
STATUS = Facet(shortest=1, longest=1, pattern="[BFPST12345]")
CATEGORY = Facet(longest=2)
PUBLIC_TIME = Facet(pattern="([0-1][0-9]|2[0-3]):[0-5][0-9]")
WORKING_TIME = Facet(pattern="([0-1][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?")
FORMATION = Facet(shortest=1, longest=20)
LOADING = Facet(at_most=100)
DATE = Facet(pattern="-?[0-9]{4,}-[0-9]{2}-[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?", day=True)
RSID = Facet(shortest=6, longest=8)
SOURCE_INSTANCE = Facet(shortest=4, longest=4)
REQUEST = Facet(shortest=1, longest=16, pattern="[-_A-Za-z0-9]{1,16}")

# (attribute, facet, required)
STATUS_RULES = (("_rid", RID, True), ("_uid", UID, True), ("_ssd", DATE, True))
STATUS_POINT_RULES = (
    ("_tpl", TIPLOC, True),
    ("_pta", PUBLIC_TIME, False),
    ("_ptd", PUBLIC_TIME, False),
    ("_wta", WORKING_TIME, False),
    ("_wtd", WORKING_TIME, False),
    ("_wtp", WORKING_TIME, False),
    ("length", TRAIN_LENGTH, False),
)
TIME_RULES = (
    ("_et", PUBLIC_TIME, False),
    ("_at", PUBLIC_TIME, False),
    ("_wet", PUBLIC_TIME, False),
    ("_srcInst", SOURCE_INSTANCE, False),
)
PLATFORM_RULES = (("_VALUE", PLATFORM, False),)
SCHEDULE_RULES = (
    ("_rid", RID, True),
    ("_uid", UID, True),
    ("_trainId", TRAIN_ID, True),
    ("_rsid", RSID, False),
    ("_ssd", DATE, True),
    ("_toc", TOC, True),
    ("_status", STATUS, False),
    ("_trainCat", CATEGORY, False),
)
POINT_RULES = (
    ("_tpl", TIPLOC, True),
    ("_act", ACTIVITY, False),
    ("_planAct", ACTIVITY, False),
    ("_fid", FORMATION, False),
    ("_avgLoading", LOADING, False),
    ("_fd", TIPLOC, False),
    ("_pta", PUBLIC_TIME, False),
    ("_ptd", PUBLIC_TIME, False),
    ("_wta", WORKING_TIME, False),
    ("_wtd", WORKING_TIME, False),
    ("_wtp", WORKING_TIME, False),
)
# Working times a calling point of each kind has to have.
REQUIRED_TIMES = {
    "OR": ("_wtd",),
    "OPOR": ("_wtd",),
    "IP": ("_wta", "_wtd"),
    "OPIP": ("_wta", "_wtd"),
    "PP": ("_wtp",),
    "DT": ("_wta",),
    "OPDT": ("_wta",),
}


def _broken(item: Column, rules) -> Column:
    """Names of the fields of one struct that break their rule."""

    def check(name: str, facet: Facet, required: bool) -> Column:
        wrong = F.when(item[name].isNull(), F.lit(required)).otherwise(~facet.holds(item[name]))
        return F.when(wrong, F.lit(name.strip("_")))

    return F.array_compact(F.array(*[check(*rule) for rule in rules]))


def _each(items: Column, found) -> Column:
    """Findings over all elements of an array, none for a NULL array."""
    return F.coalesce(F.flatten(F.transform(items, found)), F.array().cast("array<string>"))


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit(prefix), n))


def _status_findings(ts: Column) -> Column:
    def at_point(loc: Column) -> Column:
        timed = [
            F.when(loc[e].isNotNull(), _broken(loc[e], TIME_RULES)).otherwise(F.array().cast("array<string>"))
            for e in ("arr", "dep", "pass")
        ]
        plat = F.when(loc["plat"].isNotNull(), _broken(loc["plat"], PLATFORM_RULES)).otherwise(
            F.array().cast("array<string>")
        )
        return F.concat(
            _prefixed(_broken(loc, STATUS_POINT_RULES), "Location."),
            *[_prefixed(t, f"{e}.") for t, e in zip(timed, ("arr", "dep", "pass"))],
            _prefixed(plat, "plat."),
        )

    return F.concat(_prefixed(_broken(ts, STATUS_RULES), "TS."), _each(ts["Location"], at_point))


def _schedule_findings(plan: Column) -> Column:
    def at_point(kind: str):
        required = tuple((name, WORKING_TIME, True) for name in REQUIRED_TIMES[kind])
        optional = tuple(r for r in POINT_RULES if r[0] not in REQUIRED_TIMES[kind])
        return lambda p: _prefixed(_broken(p, optional + required), f"{kind}.")

    return F.concat(
        _prefixed(_broken(plan, SCHEDULE_RULES), "schedule."),
        *[_each(plan[kind], at_point(kind)) for kind in LOCATION_KINDS],
    )


def validate_feed(routed: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (sorted distinct field names, NULL if none) and ``valid`` per message.

    A message with any broken field is rejected as a whole; keep ``valid`` rows to
    go on, or archive the rest with its reasons.
    """
    box = F.col("box")
    request = _broken(F.col("doc.uR"), (("_requestID", REQUEST, False),))
    of_update = F.when(F.col("doc.uR").isNotNull(), _prefixed(request, "uR.")).otherwise(F.array().cast("array<string>"))
    findings = F.concat(of_update, _each(box["TS"], _status_findings), _each(box["schedule"], _schedule_findings))
    reason = F.array_join(F.array_sort(F.array_distinct(findings)), ",")
    checked = with_once(routed, "reject_reason", F.nullif(reason, F.lit("")))
    return checked.withColumn("valid", F.col("reject_reason").isNull())
