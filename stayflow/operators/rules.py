"""The rule-based feature block of the fixed-line model, driven by rule tables.

Every rule is a Column built from a table below, and the whole block is one
projection; nothing is fitted, so training and scoring share the same expressions.
Missing text arrives as the word ``None``.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stayflow.functions.columns import (
    compare_to_history,
    first_match,
    flag,
    keep_listed,
    map_levels,
    row_max,
    truth,
)

# Fixed values of the rules follow, as the features must come out the same.

# the first word found names the department or tier
DEPARTMENT_WORDS = [("retention", "Retention"), ("sales", "Sales")]

INTERACTION_REASONS = ["BILLING", "DATA", "VIDEO", "GENERAL", "RETENTION", "SALES", "APPOINTMENT", "NONE"]

REPEAT_DEPARTMENTS = ["CUSTOMER SERVICE REP", "TECHNICAL SERVICE REP", "NONE"]

SPEEDS = ["0", "25", "30", "50", "100", "200", "300", "400", "500", "1000"]

SPEED_TEXT = [("BROADBAND INTERNET ", ""), ("None", "0"), ("GBPS", "000")]

TIERS = {"None": 0, "BASIC": 1, "ECONOMY": 2, "CORE": 3, "VALUE": 4, "SELECT": 5, "PREMIER": 6, "ALL_OTHER": -1}

TIER_WORDS = ["basic", "economy", "core", "value", "select", "premier", "free", "bulk", "family"]

NO_OFFER = ["NO OFFER", "NONE"]

TENURE_DAYS = [(182, "0_6mon"), (365, "6_12mon"), (730, "12_24mon"), (1825, "24_60mon")]
TENURE_REST = "morethan_60mon"


def ebill(c: Column) -> Column:
    return F.when(F.upper(c).isin("EBILL AND PRINT STATEMENT", "EBILL ONLY"), "Ebill").otherwise(c)


def department(c: Column, unknown_to_none: bool = False) -> Column:
    out = first_match(c, DEPARTMENT_WORDS)
    return F.when(F.upper(c) == "UNKNOWN", "None").otherwise(out) if unknown_to_none else out


def interaction_reason(c: Column) -> Column:
    return keep_listed(c, INTERACTION_REASONS)


def end_result(c: Column) -> Column:
    return F.when(F.upper(c) == "NONE", "Success").otherwise(c)


def repeat_department(c: Column) -> Column:
    return keep_listed(F.when(F.upper(c) == "UNKNOWN", "None").otherwise(c), REPEAT_DEPARTMENTS)


def parse_speed(c: Column, replacements: Sequence[tuple[str, str]] = SPEED_TEXT) -> Column:
    """Text replacements, then the part before ``/`` and ``-`` as a number.

    Brand words of a market go in front of the default replacements.
    """
    for old, new in replacements:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.element_at(F.split(F.element_at(F.split(c, "/"), 1), "-"), 1).try_cast("double")


def speed_level(speed: Column, levels: Sequence[str] = SPEEDS) -> Column:
    """Known speeds as text without decimals, the rest ``ALL_OTHER``; missing stays missing."""
    text = speed.cast("bigint").cast("string")
    return F.when(speed.isNull() | text.isin(list(levels)), text).otherwise("ALL_OTHER")


def speed_change(now: Column, history: Sequence[Column]) -> Column:
    return compare_to_history(now, history, ("same", "higher", "lower"))


def yes(c: Column) -> Column:
    return flag(F.upper(c) == "Y")


def has_offer(c: Column) -> Column:
    return F.when(truth(F.upper(c).isin(NO_OFFER)), 0).otherwise(1)


def has_visit(c: Column) -> Column:
    return F.when(truth(F.upper(c) == "NONE"), 0).otherwise(1)


def subscription_change(now: Column, history: Sequence[Column]) -> Column:
    """``Y`` flags now against the best of earlier months: same, up or down."""
    return compare_to_history(yes(now), [yes(c) for c in history])


def revenue_number(c: Column) -> Column:
    return F.when(c.cast("string") == "None", 0.0).otherwise(c.cast("string").try_cast("double"))


def tier_name(c: Column, words: Sequence[str] = TIER_WORDS, known: Sequence[str] = tuple(TIERS)) -> Column:
    """The first listed word contained in the text names the tier; unnamed tiers pool."""
    out = first_match(c, [(w, w.upper()) for w in words])
    return keep_listed(out, [k for k in known if k != "ALL_OTHER"])


def tier_code(name: Column, codes: Mapping[str, int] = TIERS) -> Column:
    return map_levels(name, codes)


def tier_change(now: Column, history: Sequence[Column]) -> Column:
    """Codes now against the best earlier code; a pooled tier on one side gives OTHER."""
    moved = compare_to_history(now, history, ("same", "higher", "lower"))
    pooled = truth(now == -1) | truth(row_max(history) == -1)
    return F.when((moved != "same") & pooled, "OTHER").otherwise(moved)


def any_change(now: Column, history: Sequence[Column]) -> Column:
    """0 when all months are equal, 1 otherwise, also when one is missing."""
    same = now == history[0]
    for c in history[1:]:
        same = same & (now == c)
    return F.when(truth(same), 0).otherwise(1)


def tenure_bucket(days: Column, steps: Sequence[tuple[int, str]] = TENURE_DAYS, rest: str = TENURE_REST, missing: str | None = "nan") -> Column:
    chain = None
    for upto, label in steps:
        chain = F.when(days <= upto, F.lit(label)) if chain is None else chain.when(days <= upto, F.lit(label))
    return chain.when(days.isNotNull(), F.lit(rest)).otherwise(F.lit(missing).cast("string"))


def cross(*cols: Column) -> Column:
    """Levels joined by ``_``; a missing part makes the whole missing."""
    parts = [cols[0]]
    for c in cols[1:]:
        parts += [F.lit("_"), c]
    return F.concat(*parts)


def not_none(c: Column) -> Column:
    """Text other than ``None``; a missing value also counts as a value."""
    return F.coalesce(F.upper(c) != "NONE", F.lit(True))


def is_none(c: Column) -> Column:
    return truth(F.upper(c) == "NONE")


def repeat_flags(last: Column, repeats: Sequence[Column]) -> list[Column]:
    """Calls followed by exactly 1, 2 and at least 3 repeats."""
    out = []
    for i, r in enumerate(repeats):
        cond = not_none(last) & not_none(r)
        out.append(flag(cond & is_none(repeats[i + 1]) if i + 1 < len(repeats) else cond))
    return out


def visit_flags(visits: Sequence[Column]) -> list[Column]:
    """Exactly 1, 2 and at least 3 visits, from 0/1 visit columns."""
    out = []
    for i, v in enumerate(visits):
        out.append(flag((v == 1) & (visits[i + 1] == 0) if i + 1 < len(visits) else v == 1))
    return out


def competition_label(flags: Mapping[str, Column]) -> Column:
    """Names of the set flags joined by commas, ``NONE`` when no flag is set."""
    names = F.concat_ws(",", *[F.when(truth(c == 1), F.lit(n)) for n, c in flags.items()])
    return F.when(names == "", "NONE").otherwise(names)


def rule_block(df: DataFrame, speed_words: Sequence[tuple[str, str]] = SPEED_TEXT) -> DataFrame:
    """All rules on a fixed-line table: reduced levels, changes, crosses and flags.

    Inputs that served only to build a change feature are left out of the result.
    """
    c = F.col
    months = range(5)
    visits = [c(f"service_visit_{k}_tc_problem_code_desc") for k in (1, 2, 3)]
    agent = department(c("agent_last_dept"))
    repeats = [c(f"agent_repeat_{k}_prevDept") for k in (1, 2, 3)]
    revenue = [revenue_number(c(f"baserev_m{k}")) for k in range(7)]
    speeds = [parse_speed(c(f"speed_m{k}"), speed_words) for k in months]
    speed = speed_level(speeds[0])
    tiers = [tier_name(c(f"curr_video_tier_desc_m{k}")) for k in months]
    codes = [tier_code(t) for t in tiers]
    tenure = tenure_bucket(c("cust_tenure_days").try_cast("double"))
    visit = [has_visit(v) for v in visits]
    once = repeat_flags(agent, repeats)
    seen = visit_flags(visit)
    distress = {
        "OFFLINE": "FAILSTAT_OFFLINEEVT",
        "DHCP": "FAILSTAT_DHCP_MACADDR",
        "WIFIReboot": "FAILSTAT_WIFI_REBOOT_COUNT",
        "WIFIQoE": "FAILSTAT_WIFI_QOE_HOME_30",
    }
    new: dict[str, Column] = {
        "ebill_status_desc": ebill(c("ebill_status_desc")),
        "agent_last_dept": agent,
        "ivr_last_dept": department(c("ivr_last_dept"), unknown_to_none=True),
        "ivr_last_interactionReason": interaction_reason(c("ivr_last_interactionReason")),
        "ivr_last_ivrInteractionEndResult": end_result(c("ivr_last_ivrInteractionEndResult")),
        **{f"ivr_repeat_{k}_prevInteractionReason": interaction_reason(c(f"ivr_repeat_{k}_prevInteractionReason")) for k in (1, 2, 3)},
        **{f"ivr_repeat_{k}_prevDept": repeat_department(c(f"ivr_repeat_{k}_prevDept")) for k in (1, 2, 3)},
        "speed_m0": speed,
        "speed_change_m4m0": speed_change(speeds[0], speeds[1:]),
        **{f"{s}_change_m3m1": subscription_change(c(f"{p}_m1"), [c(f"{p}_m2"), c(f"{p}_m3")])
           for s, p in (("max_svod", "max_svod"), ("hbo_svod", "hbo_svod_new"), ("stz_enc_svod", "stz_enc_svod"))},
        "baserev_change_m6m0": compare_to_history(revenue[0], revenue[1:]),
        "curr_video_tier_desc_m0": tiers[0],
        "video_tier_change_m4m0": tier_change(codes[0], codes[1:]),
        "ov_tier_change_m4m0": any_change(c("curr_ov_tier_desc_m0"), [c(f"curr_ov_tier_desc_m{k}") for k in range(1, 5)]),
        **{f"{p}_m{k}": has_offer(c(f"{p}_m{k}"))
           for p in ("ool_offer_group_v2_desc", "ov_offer_group_v2_desc", "video_offer_group_desc") for k in months},
        **{f"service_visit_{k}_tc_{w}_code_desc": has_visit(c(f"service_visit_{k}_tc_{w}_code_desc")) for k in (1, 2, 3) for w in ("problem", "fix")},
        "cust_tenure": tenure,
        "promo_rolloff_count_60day": F.when(c("promo_rolloff_count_60day") > 0, 1).otherwise(c("promo_rolloff_count_60day")),
        "cust_equip_class_speedm0": cross(c("cust_equip_class"), speed),
        "tenure_productclass": cross(tenure, c("product_class_desc")),
        "tenure_income": cross(tenure, c("ecohort_income_range_desc")),
        "rateevent_baserevchange": flag((c("rate_event_count_60day") > 0) & (revenue[0] - revenue[1] != 0)),
        **{f"agentcall_and_repeat{k + 1}": once[k] for k in range(3)},
        "servicevisit_once": seen[0],
        "servicevisit_twotimes": seen[1],
        "servicevisit_threetimes": seen[2],
        "agentcall_servicevisit": flag(not_none(agent) & (visit[0] == 1)),
        **{f"agentlastdep_{n}distress": cross(F.coalesce(agent, F.lit("None")), flag(c(f) > 0).cast("string")) for n, f in distress.items()},
    }
    used = {
        *[f"speed_m{k}" for k in range(1, 5)], *[f"curr_video_tier_desc_m{k}" for k in range(1, 5)],
        *[f"curr_ov_tier_desc_m{k}" for k in months], *[f"baserev_m{k}" for k in range(7)],
        *[f"{p}_m{k}" for p in ("max_svod", "hbo_svod_new", "stz_enc_svod") for k in (1, 2, 3)],
        "cust_tenure_days", "metro_area_desc",
    }
    rest = [c(n) for n in df.columns if n not in used and n not in new]
    return df.select(*rest, *[v.alias(n) for n, v in new.items()])
