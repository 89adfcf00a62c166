"""Business classifications as native column expressions (no Python UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Value of the first rule whose condition is true; ``default`` (or NULL) if none is."""
    head, *rest = rules
    chain = reduce(lambda c, rule: c.when(*rule), rest, F.when(*head))
    return chain if default is None else chain.otherwise(default)


def labelled(value: Column, limits: list[tuple[float, str]], above: str) -> Column:
    """Label of the first upper limit (inclusive) that holds ``value``; ``above`` otherwise."""
    return first_match([(value <= limit, F.lit(label)) for limit, label in limits], F.lit(above))


def _by_level(level: Column, labels: tuple[Column | str | None, ...], default: str | None = None) -> Column:
    pairs = [
        (level == n, value if isinstance(value, Column) else F.lit(value))
        for n, value in enumerate(labels, start=1)
        if value is not None
    ]
    return first_match(pairs, None if default is None else F.lit(default))


# Attribution labels by level (category, area, reason, detail), in rule order.
FULL_LABELS = {
    "compliant_weekend": ("COMPLIANT", "COMPLIANT", "Excess Carry Overs - Weekend Protection",
                          "Trailer count matches plan with 2+ trailers carried over to protect the weekend"),
    "compliant_notice": ("COMPLIANT", "COMPLIANT", "Excess Carry Overs - 24-Hour Notice",
                         "Trailer count matches plan with 2+ trailers carried over due to 24-hour rule"),
    "compliant": ("COMPLIANT", "COMPLIANT", "Compliant", "Compliant"),
    "under_request": ("UNDER", "EXTERNAL_REQUEST"),
    "under_available": ("UNDER", "TRANSPORTATION", "Guaranteed Delivery - Trailer Available",
                        "1st trailer of a planned day was available but not sent"),
    "under_must_ship": ("UNDER", "TRANS_DC_HANDOFF", "Must Ship - No Trailer Available",
                        "No trailer was available to send on a must ship date"),
    "under_buffer": ("UNDER", "FORECAST", "Forecast Buffer Too High",
                     "Too high of forecast buffers put in place"),
    "over_unplanned": ("OVER", "TRANSPORTATION", "Delivery On Non-Delivery Date",
                       "A trailer was sent on an unplanned day"),
    "over_no_carry": ("OVER", "TRANSPORTATION", "Zero Trailers Carried Over",
                      "A trailer was sent over plan when it could have been carried over"),
    "over_after_under": ("OVER", "TRANS_DC_HANDOFF", "Over Plan Day Caused By Under Plan Day",
                         "A trailer was sent over plan to make up for a previous under plan day"),
    "over_low_util": ("OVER", "DC_OPS", "Average Trailer Utilization Below 75%",
                      "An extra trailer was created due to low average utilization over last 7 days"),
    "over_low_forecast": ("OVER", "FORECAST", "Forecasted Plan Was Too Low",
                          "Trailer volume forecasted was too low"),
}

# Fixed value: utilisation below which an extra trailer counts as caused by loading.
LOW_UTILISATION = 0.75


def compliance_attribution(
    daily_plan: Column, daily_actl: Column, weekend_protection_ind: Column,
    prev_day_notice_ind: Column, daily_available: Column, next_day_available: Column,
    trailer_idx: Column, must_ship_flag: Column, carry_over_count: Column,
    next_day_plan: Column, l7_under_ind: Column, l7_trlr_util_pct: Column,
    l3w_inventory_ind: Column, req_type: Column, req_reason: Column, lvl: Column,
) -> Column:
    """Why a store-day met, missed or exceeded its trailer plan, at detail level 1 to 4.

    Twelve rules in order; a day under plan with at least one delivery matches
    none and gives NULL. ``trailer_idx`` and ``l3w_inventory_ind`` belong to the
    signature but do not influence the result.
    """
    met = daily_actl == daily_plan
    missed = (daily_actl < daily_plan) & (daily_actl == 0)
    available = F.coalesce(daily_available, F.lit(0))
    exceeded = daily_actl > daily_plan
    exceeded_planned = exceeded & (daily_plan > 0)
    carried_enough = (carry_over_count > 0) | ((carry_over_count == 0) & (next_day_plan == 0))
    after_full_week = exceeded_planned & carried_enough & ~l7_under_ind
    conditions = {
        "compliant_weekend": met & (carry_over_count > 1) & weekend_protection_ind,
        "compliant_notice": met & (carry_over_count > 1) & prev_day_notice_ind,
        "compliant": met,
        "under_request": missed & (available > 0) & (req_type == "UNDER"),
        "under_available": missed & (available > 0),
        "under_must_ship": missed & (available == 0) & (must_ship_flag == "Y"),
        "under_buffer": missed & (available == 0) & (must_ship_flag == "N") & (next_day_available == 0),
        "over_unplanned": exceeded & (daily_plan == 0),
        "over_no_carry": exceeded_planned & (carry_over_count == 0) & (next_day_plan > 0),
        "over_after_under": exceeded_planned & carried_enough & l7_under_ind,
        "over_low_util": after_full_week & (l7_trlr_util_pct < LOW_UTILISATION),
        "over_low_forecast": after_full_week
        & ((l7_trlr_util_pct >= LOW_UTILISATION) | l7_trlr_util_pct.isNull()),
    }
    rules = []
    for name, condition in conditions.items():
        labels = FULL_LABELS[name]
        if name == "under_request":
            value = _by_level(lvl, (*labels, req_reason, req_reason))
        elif name.startswith("compliant"):
            value = _by_level(lvl, (None, None, *labels[2:]), default=labels[0])
        else:
            value = _by_level(lvl, labels)
        rules.append((condition, value))
    return first_match(rules)


# Labels of the short attribution form, in rule order.
SIMPLE_LABELS = {
    "compliant": ("COMPLIANT", "COMPLIANT", "Trailer count matches plan", "Trailer count matches plan"),
    "under_available": ("UNDER", "TRANSPORTATION", "Guaranteed Delivery Missed",
                        "Trailer was available but not dispatched"),
    "under_must_ship": ("UNDER", "DC_HANDOFF", "Must Ship Missed",
                        "No trailer available on must-ship date"),
    "over_unplanned": ("OVER", "TRANSPORTATION", "Unplanned Delivery",
                       "Trailer sent on non-delivery date"),
    "over_no_carry": ("OVER", "TRANSPORTATION", "Zero Carry Over",
                      "Trailer sent when it could have been held"),
}


def compliance_attribution_simple(
    daily_plan: Column, daily_actual: Column, carry_over_count: Column,
    must_ship_flag: Column, trailers_available: Column, level: Column,
) -> Column:
    """Five-rule form of the attribution; levels above 3 give the detail text."""
    under, over = daily_actual < daily_plan, daily_actual > daily_plan
    conditions = {
        "compliant": daily_actual == daily_plan,
        "under_available": under & (trailers_available > 0),
        "under_must_ship": under & (must_ship_flag == "Y"),
        "over_unplanned": over & (daily_plan == 0),
        "over_no_carry": over & (carry_over_count == 0),
    }
    rules = []
    for name, condition in conditions.items():
        category, area, reason, detail = SIMPLE_LABELS[name]
        if name == "compliant":
            value = F.when(level <= 2, category).otherwise(reason)
        else:
            value = _by_level(level, (category, area, reason), default=detail)
        rules.append((condition, value))
    return first_match(rules)


# Cube above which a trailer measurement is not believed, and the bucket labels.
CUBE_CEILING = 4050
UTILISATION_LIMITS = [(0.25, "0% - 25%"), (0.50, "25% - 50%"), (0.75, "50% - 75%"), (0.85, "75% - 85%")]
UTILISATION_LIMITS_SHORT = [(0.25, "0-25%"), (0.50, "25-50%"), (0.75, "50-75%"), (0.85, "75-85%")]


def utilisation_group(cube: Column, util: Column) -> Column:
    """Dashboard bucket; unbelievable cube and unknown utilisation are 'OTHER'."""
    bucket = labelled(util, UTILISATION_LIMITS, "FULL")
    return F.when((cube > CUBE_CEILING) | util.isNull(), "OTHER").otherwise(bucket)


def utilisation_bucket(cube: Column, util: Column) -> Column:
    """Condensed bucket: unbelievable cube is 'INVALID', everything unmatched is full."""
    return F.when(cube > CUBE_CEILING, "INVALID").otherwise(
        labelled(util, UTILISATION_LIMITS_SHORT, "FULL (85%+)")
    )


def trailer_status(carry_over: Column, over_plan: Column, pull_forward: Column, end_trip: Column) -> Column:
    return first_match(
        [
            (carry_over & over_plan, F.lit("CARRY OVER - OVER CAP")),
            (pull_forward & over_plan, F.lit("PULL FORWARD - OVER CAP")),
            (carry_over, F.lit("CARRY OVER")),
            (over_plan, F.lit("OVER CAP")),
            (pull_forward, F.lit("PULL FORWARD")),
            (end_trip.isNotNull(), F.lit("DELIVERED")),
        ],
        F.lit("ON PROCESS"),
    )


def plan_compliance(date: Column, today: Column, actual: Column, plan: Column) -> Column:
    """OVER / UNDER / COMPLIANT for past and present days, NULL for future ones."""
    verdict = F.when(actual > plan, "OVER").when(actual < plan, "UNDER").otherwise("COMPLIANT")
    return F.when(date > today, F.lit(None).cast("string")).otherwise(verdict)


def real_trailer(trailer_id: Column) -> Column:
    """Trailer number that is not a planning placeholder."""
    return ~F.upper(F.trim(trailer_id)).like("%P-%")


def lineage(primary_known: Column, secondary_known: Column) -> Column:
    return (
        F.when(primary_known & secondary_known, "BOTH").when(primary_known, "MODERN").otherwise("LEGACY")
    )


def activity_minutes(check_in: Column, check_out: Column, minutes: Column, longest: int = 1440) -> Column:
    """Minutes on site; unknown, negative and over-long stays are NULL."""
    return F.when((check_out >= check_in) & (minutes <= longest), minutes)


def productivity_status(minutes: Column) -> Column:
    return (
        F.when(minutes >= 480, "FULL_DAY")
        .when(minutes >= 240, "HALF_DAY")
        .when(minutes > 0, "PARTIAL")
        .otherwise("NO_ACTIVITY")
    )


# Code descriptions and service-level hours.
PRIORITY_NAMES = {"E": "Emergency", "U": "Urgent", "R": "Routine", "P": "Planned"}
TECH_TYPE_NAMES = {
    "GM": "General Maintenance", "HVAC": "HVAC/Refrigeration",
    "FOOD": "Food Equipment", "LAND": "Landscaping",
}
SLA_HOURS = {"E": 4, "U": 24, "R": 72}


def described(code: Column, names: dict[str, str], default: str) -> Column:
    return first_match([(code == k, F.lit(v)) for k, v in names.items()], F.lit(default))


def sla_status(priority: Column, hours_to_start: Column, completed: Column) -> Column:
    met = [(((priority == p) & (hours_to_start <= h)), F.lit("MET")) for p, h in SLA_HOURS.items()]
    return first_match([*met, (completed.isNull(), F.lit("IN_PROGRESS"))], F.lit("MISSED"))


# Work-order age buckets in days.
AGE_LIMITS = [(1, "0-1 Days"), (3, "2-3 Days"), (7, "4-7 Days"), (14, "8-14 Days"), (30, "15-30 Days")]


def age_bucket(days: Column) -> Column:
    return labelled(days, AGE_LIMITS, "30+ Days")


def milestone_status(latest_first: list[tuple[Column, str]], default: str) -> Column:
    """State named by the most advanced milestone reached."""
    return first_match([(ts.isNotNull(), F.lit(state)) for ts, state in latest_first], F.lit(default))


def lead_time_trend(value: Column, last_year: Column) -> Column:
    return (
        F.when(value > last_year * 1.1, "INCREASING")
        .when(value < last_year * 0.9, "DECREASING")
        .otherwise("STABLE")
    )


# p90 lead-time grades in days.
LANE_GRADES = [(45, "EXCELLENT"), (60, "GOOD"), (75, "FAIR")]


def lane_performance(p90: Column) -> Column:
    return labelled(p90, LANE_GRADES, "NEEDS_IMPROVEMENT")


def versus_lane(value: Column, lane_average: Column) -> Column:
    return (
        F.when(value > lane_average, "ABOVE_AVG")
        .when(value < lane_average * 0.8, "BELOW_AVG")
        .otherwise("AT_AVG")
    )


# Facility numbers, and the flow facility fed by each storage facility.
STORAGE_SITES = [6060, 6061, 6088, 7042, 7067, 7078]
FLOW_SITES = [7085, 7086, 7089, 7092, 7093, 7094, 8695, 9631]
STORAGE_TO_FLOW = {6060: 7089, 6061: 7086, 6088: 7093, 7042: 7085, 7078: 7094, 7067: 8695}
REROUTED_PO_TYPES = [43, 45, 46]
OFFSET_SITE = 7092
OFFSET_PO_TYPES = [40, 42]
# Service departments kept out of planning.
SERVICE_DEPTS = [15, 37, 38, 39, 49, 58, 60, 65, 69, 75, 85, 86, 88, 89, 99]


def channel_method(site: Column, storage: list | None = None, flow: list | None = None) -> Column:
    return (
        F.when(site.isin(storage or STORAGE_SITES), "STORAGE")
        .when(site.isin(flow or FLOW_SITES), "FLOW")
        .otherwise("OTHER")
    )


def rerouted_site(
    po_type: Column, site: Column, types: list | None = None, routes: dict | None = None
) -> Column:
    """Flow facility that stands for a storage facility on re-routed order types."""
    moved = po_type.isin(types or REROUTED_PO_TYPES)
    return first_match(
        [(moved & (site == k), F.lit(v)) for k, v in (routes or STORAGE_TO_FLOW).items()], site
    )


def ecommerce_indicator(buying_region: Column, event_code: Column) -> Column:
    return F.when((buying_region == 6) | event_code.like("%ONLINE%"), "Y").otherwise("N")


def receipt_offset_flag(ecommerce: Column, site: Column, po_type: Column, channel: Column) -> Column:
    flagged = (ecommerce == "Y") | (site == OFFSET_SITE) | (po_type.isin(OFFSET_PO_TYPES) & (channel == "FLOW"))
    return F.when(flagged, "Y").otherwise("N")


def corrected_ready(ready: Column, adjusted: Column, door_close: Column) -> Column:
    """Ready time that lies before the door closed moves to the later of the two known facts.

    Equality or an unknown time leaves the ready time as it was.
    """
    early = ready < door_close
    return (
        F.when(early & (adjusted > door_close), adjusted)
        .when(early & (adjusted < door_close), door_close)
        .otherwise(ready)
    )
