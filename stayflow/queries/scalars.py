"""Scalar functions, rule block, column plumbing and files."""
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.functions import columns as fc, keys, months
from stayflow.operators import categorical as ca, cohort as co, columns as pc, prep, rules
from stayflow.queries.registry import query
from stayflow.queries.views import cut_sql, with_views
from stayflow.session import new_folder
from stayflow.sources import files

# --- keys and months ---

query(
    "key_split",
    with_views(
        "v4",
        select="""SELECT chc_id, substr(corp_house_cust,1,4) AS corp,
  coalesce(nullif(regexp_replace(substr(corp_house_cust,5,6),'^0+',''),''),'0') AS house,
  coalesce(nullif(regexp_replace(substr(corp_house_cust,11),'^0+',''),''),'0') AS cust FROM v4""",
    ),
)(lambda s, sf: fx.text_history(s, sf).select("chc_id", *[c.alias(n) for n, c in keys.split_key(F.col("corp_house_cust")).items()]))

query(
    "key_build",
    "SELECT c_custkey, concat('701', concat(repeat('0', CAST(greatest(0, 6 - length(CAST(c_custkey AS VARCHAR))) AS INT)), CAST(c_custkey AS VARCHAR)), concat(repeat('0', CAST(greatest(0, 2 - length(CAST(c_nationkey AS VARCHAR))) AS INT)), CAST(c_nationkey AS VARCHAR))) AS corp_house_cust FROM customer",
)(
    lambda s, sf: fx.table(s, sf, "customer").select(
        "c_custkey", keys.build_key(F.lit(701), F.col("c_custkey"), F.col("c_nationkey"), grow=True).alias("corp_house_cust")
    )
)

query(
    "month_list",
    with_views(
        "v1",
        select="SELECT DISTINCT dt, k AS step, CAST(strftime(strptime(CAST(dt AS VARCHAR)||'01','%Y%m%d') + to_months(k), '%Y%m') AS INT) AS ym FROM v1, (SELECT CAST(unnest([-1,1,2,3,4,5,6]) AS INT) AS k)",
    ),
)(
    lambda s, sf: fx.cust_month(s, sf).select("dt").distinct()
    .select("dt", F.explode(F.array(*[F.lit(k) for k in (-1, 1, 2, 3, 4, 5, 6)])).alias("step"))
    .select("dt", "step", months.shift_month(F.col("dt"), F.col("step")).alias("ym"))
)

query(
    "month_label",
    with_views("v1", select="SELECT DISTINCT dt, lower(strftime(strptime(CAST(dt AS VARCHAR)||'01','%Y%m%d'),'%b%y')) AS label, dt AS back FROM v1"),
)(
    lambda s, sf: fx.cust_month(s, sf).select("dt").distinct()
    .select("dt", months.month_label(F.col("dt")).alias("label"))
    .select("dt", "label", months.label_month(F.col("label")).alias("back"))
)

query(
    "safe_cast",
    "SELECT event_id, TRY_CAST(CASE WHEN event_type='view' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS id, TRY_CAST(event_type AS DOUBLE) AS bad FROM events",
)(
    lambda s, sf: fx.table(s, sf, "events").select(
        "event_id",
        fc.safe_number(F.when(F.col("event_type") == "view", "n/a").otherwise(F.col("user_id").cast("string")), "bigint").alias("id"),
        fc.safe_number(F.col("event_type")).alias("bad"),
    )
)

# --- text rules on the history view ---

_SPEED = "TRY_CAST(split_part(split_part(replace(replace(replace({c},'BROADBAND INTERNET ',''),'None','0'),'GBPS','000'),'/',1),'-',1) AS DOUBLE)"
_HIST = ", ".join(f"{_SPEED.format(c=f'tier_m{k}')} AS s{k}" for k in range(5))


def _speeds(df):
    return [rules.parse_speed(F.col(f"tier_m{k}")) for k in range(5)]


query("speed_parse", with_views("v4", select=f"SELECT chc_id, {_HIST} FROM v4"))(
    lambda s, sf: (lambda d: d.select("chc_id", *[c.alias(f"s{k}") for k, c in enumerate(_speeds(d))]))(fx.text_history(s, sf))
)

query(
    "history_change",
    with_views(
        "v4", f"p AS (SELECT chc_id, {_HIST} FROM v4)",
        select="""SELECT chc_id, CASE WHEN s0 = greatest(s1,s2,s3,s4) THEN 'same' WHEN s0 > greatest(s1,s2,s3,s4) THEN 'higher' ELSE 'lower' END AS speed_change FROM p""",
    ),
)(
    lambda s, sf: (lambda d: d.select("chc_id", rules.speed_change(_speeds(d)[0], _speeds(d)[1:]).alias("speed_change")))(fx.text_history(s, sf))
)

query(
    "flag_history_change",
    with_views(
        "v4",
        select="""SELECT chc_id, CASE WHEN a = greatest(b,c) THEN 'same' WHEN a > greatest(b,c) THEN 'up' ELSE 'down' END AS change FROM
 (SELECT chc_id, CASE WHEN substr(tier_m1,1,1)='1' THEN 1 ELSE 0 END AS a, CASE WHEN substr(tier_m2,1,1)='1' THEN 1 ELSE 0 END AS b,
  CASE WHEN substr(tier_m3,1,1)='1' THEN 1 ELSE 0 END AS c FROM v4)""",
    ),
)(
    lambda s, sf: fx.text_history(s, sf).select(
        "chc_id",
        rules.subscription_change(*(lambda y: (y[0], y[1:]))([F.when(F.col(f"tier_m{k}").startswith("1"), "y").otherwise("n") for k in (1, 2, 3)])).alias("change"),
    )
)

query(
    "revenue_change",
    with_views(
        "v1",
        select="""SELECT chc_id, dt, CASE WHEN rev_m0 = greatest(rev_m1,rev_m2,rev_m3) THEN 'same' WHEN rev_m0 > greatest(rev_m1,rev_m2,rev_m3) THEN 'up' ELSE 'down' END AS change FROM v1""",
    ),
)(
    lambda s, sf: fx.cust_month(s, sf).select(
        "chc_id", "dt", fc.compare_to_history(F.col("rev_m0"), [F.col(f"rev_m{k}") for k in (1, 2, 3)]).alias("change")
    )
)

query(
    "level_reduce",
    with_views(
        "v4",
        select="""SELECT chc_id,
  CASE WHEN upper(tier_m0) IN ('1-URGENT','2-HIGH','NONE') THEN tier_m0 ELSE 'ALL_OTHER' END AS listed,
  CASE WHEN lower(tier_m0) LIKE '%high%' THEN 'Retention' WHEN lower(tier_m0) LIKE '%low%' THEN 'Sales' ELSE tier_m0 END AS named,
  CASE WHEN upper(tier_m4) = 'NONE' THEN 'Success' ELSE tier_m4 END AS result FROM v4""",
    ),
)(
    lambda s, sf: fx.text_history(s, sf).select(
        "chc_id",
        fc.keep_listed(F.col("tier_m0"), ["1-urgent", "2-high", "none"]).alias("listed"),
        fc.first_match(F.col("tier_m0"), [("high", "Retention"), ("low", "Sales")]).alias("named"),
        rules.end_result(F.col("tier_m4")).alias("result"),
    )
)

query(
    "flag_encode",
    with_views(
        "v4",
        select="""SELECT chc_id, CASE WHEN upper(tier_m4) IN ('NO OFFER','NONE') THEN 0 ELSE 1 END AS offer,
  CASE WHEN upper(tier_m3) = 'NONE' THEN 0 ELSE 1 END AS visit, CASE WHEN upper(substr(tier_m0,3,1)) = 'Y' THEN 1 ELSE 0 END AS yes FROM v4""",
    ),
)(
    lambda s, sf: fx.text_history(s, sf).select(
        "chc_id",
        rules.has_offer(F.col("tier_m4")).alias("offer"),
        rules.has_visit(F.col("tier_m3")).alias("visit"),
        rules.yes(F.substring("tier_m0", 3, 1)).alias("yes"),
    )
)

CODES = {"None": 0, "1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}
_CODE = "CASE {c} WHEN 'None' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE -1 END"

query(
    "dict_map",
    with_views("v4", select=f"SELECT chc_id, {_CODE.format(c='tier_m0')} AS code, tier_m0 AS back FROM v4"),
)(
    lambda s, sf: fx.text_history(s, sf)
    .select("chc_id", "tier_m0", fc.map_levels(F.col("tier_m0"), CODES, F.lit(-1)).alias("code"))
    .select("chc_id", "code", fc.map_levels(F.col("code"), {v: k for k, v in CODES.items()}, F.col("tier_m0")).alias("back"))
)

query(
    "tier_change",
    with_views(
        "v4", "p AS (SELECT chc_id, " + ", ".join(f"{_CODE.format(c=f'tier_m{k}')} AS c{k}" for k in range(5)) + " FROM v4)",
        "q AS (SELECT *, greatest(c1,c2,c3,c4) AS b FROM p)",
        select="""SELECT chc_id, CASE WHEN c0 = b THEN 'same' WHEN c0 = -1 OR b = -1 THEN 'OTHER' WHEN c0 > b THEN 'higher' ELSE 'lower' END AS change FROM q""",
    ),
)(
    lambda s, sf: (
        lambda codes: fx.text_history(s, sf).select("chc_id", rules.tier_change(codes[0], codes[1:]).alias("change"))
    )([fc.map_levels(F.col(f"tier_m{k}"), CODES, F.lit(-1)) for k in range(5)])
)

query(
    "tier_levels",
    with_views(
        "v4",
        select="""SELECT chc_id, CASE WHEN t IN ('BASIC','ECONOMY') THEN t WHEN t = 'None' THEN t ELSE 'ALL_OTHER' END AS tier,
  CASE t WHEN 'BASIC' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'None' THEN 0 ELSE -1 END AS code FROM
 (SELECT chc_id, CASE WHEN tier_m4 LIKE '%URGENT%' THEN 'BASIC' WHEN tier_m4 LIKE '%LOW%' THEN 'ECONOMY' ELSE tier_m4 END AS t FROM v4)""",
    ),
)(
    lambda s, sf: fx.text_history(s, sf)
    .select("chc_id", rules.tier_name(F.replace(F.replace("tier_m4", F.lit("URGENT"), F.lit("the Basic pack")), F.lit("LOW"), F.lit("economy plan"))).alias("tier"))
    .select("chc_id", "tier", rules.tier_code(F.col("tier")).alias("code"))
)

query("any_change", with_views("v4", select="SELECT chc_id, CASE WHEN tier_m0=tier_m1 AND tier_m0=tier_m2 AND tier_m0=tier_m3 AND tier_m0=tier_m4 THEN 0 ELSE 1 END AS changed FROM v4"))(
    lambda s, sf: fx.text_history(s, sf).select("chc_id", rules.any_change(F.col("tier_m0"), [F.col(f"tier_m{k}") for k in range(1, 5)]).alias("changed"))
)

query(
    "compound_flags",
    with_views(
        "v4",
        select="""SELECT chc_id,
  CASE WHEN upper(tier_m0)<>'NONE' AND upper(tier_m2)<>'NONE' AND upper(tier_m3)='NONE' THEN 1 ELSE 0 END AS repeat_1,
  CASE WHEN upper(tier_m0)<>'NONE' AND upper(tier_m3)<>'NONE' AND upper(tier_m4)='NONE' THEN 1 ELSE 0 END AS repeat_2,
  CASE WHEN upper(tier_m0)<>'NONE' AND upper(tier_m4)<>'NONE' THEN 1 ELSE 0 END AS repeat_3,
  CASE WHEN n_orders > 3 AND n_orders <= 6 THEN 1 ELSE 0 END AS visit_1, CASE WHEN n_orders > 6 AND n_orders <= 9 THEN 1 ELSE 0 END AS visit_2,
  CASE WHEN n_orders > 9 THEN 1 ELSE 0 END AS visit_3 FROM v4""",
    ),
)(lambda s, sf: _compound(fx.text_history(s, sf)))


def _compound(df):
    c = F.col
    repeats = rules.repeat_flags(c("tier_m0"), [c("tier_m2"), c("tier_m3"), c("tier_m4")])
    visits = rules.visit_flags([fc.flag(c("n_orders") > k) for k in (3, 6, 9)])
    return df.select("chc_id", *[x.alias(f"repeat_{i + 1}") for i, x in enumerate(repeats)], *[x.alias(f"visit_{i + 1}") for i, x in enumerate(visits)])


# --- the whole rule block, on a fixed-line table derived from the history view ---


def _swap(c: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        c = f"replace({c},'{old}','{new}')"
    return c


_DISTRESS = {"OFFLINE": "FAILSTAT_OFFLINEEVT", "DHCP": "FAILSTAT_DHCP_MACADDR", "WIFIReboot": "FAILSTAT_WIFI_REBOOT_COUNT", "WIFIQoE": "FAILSTAT_WIFI_QOE_HOME_30"}
_OFFERS = ("ool_offer_group_v2_desc", "ov_offer_group_v2_desc", "video_offer_group_desc")
_SVOD = {"max_svod": ("max_svod", "1-URGENT"), "hbo_svod": ("hbo_svod_new", "2-HIGH"), "stz_enc_svod": ("stz_enc_svod", "5-LOW")}
_KEPT = {  # inputs that the block hands on
    "chc_id": "chc_id", "cust_equip_class": "tier_m1", "product_class_desc": "CASE WHEN chc_id%3=0 THEN 'Triple' ELSE 'Single' END",
    "ecohort_income_range_desc": "CASE WHEN chc_id%7<>0 THEN tier_m2 END", "rate_event_count_60day": "chc_id%2",
    **{f"agent_repeat_{k}_prevDept": f"tier_m{k + 1}" for k in (1, 2, 3)}, **{c: f"chc_id%{k}" for k, c in enumerate(_DISTRESS.values(), start=2)},
}
# one text for both sides
_FIXED_LINE = _KEPT | {
    "ebill_status_desc": _swap("tier_m0", ("1-URGENT", "eBill only"), ("2-HIGH", "EBILL AND PRINT STATEMENT")),
    "agent_last_dept": _swap("tier_m0", ("1-URGENT", "Retention team"), ("2-HIGH", "Sales desk")),
    "ivr_last_dept": _swap("tier_m1", ("5-LOW", "Unknown"), ("3-MEDIUM", "the retention line")),
    "ivr_last_interactionReason": _swap("tier_m2", ("1-URGENT", "Billing"), ("2-HIGH", "Weather")),
    "ivr_last_ivrInteractionEndResult": "tier_m3",
    **{f"ivr_repeat_{k}_prevInteractionReason": _swap(f"tier_m{k + 1}", ("3-MEDIUM", "VIDEO")) for k in (1, 2, 3)},
    **{f"ivr_repeat_{k}_prevDept": _swap(f"tier_m{k}", ("5-LOW", "UNKNOWN"), ("2-HIGH", "Customer Service Rep")) for k in (1, 2, 3)},
    **{f"speed_m{k}": _swap(f"tier_m{k}", ("1-URGENT", "BROADBAND INTERNET 200/10"), ("2-HIGH", "1GBPS/35"), ("5-LOW", "75-UP")) for k in range(5)},
    **{f"{p}_m{k}": f"CASE WHEN tier_m{k}='{level}' THEN 'y' ELSE 'N' END" for p, level in _SVOD.values() for k in (1, 2, 3)},
    **{f"baserev_m{k}": f"CASE WHEN (n_orders+{k})%4=0 THEN 'None' ELSE CAST(n_orders*10+chc_id%{k + 2} AS STRING) END" for k in range(7)},
    **{f"curr_video_tier_desc_m{k}": _swap(f"tier_m{k}", ("1-URGENT", "Premier pack"), ("2-HIGH", "the Basic TV"), ("5-LOW", "Family mix")) for k in range(5)},
    **{f"curr_ov_tier_desc_m{k}": f"tier_m{k}" for k in range(5)},
    **{f"{p}_m{k}": _swap(f"tier_m{k}", (level, "No Offer")) for p, level in zip(_OFFERS, ("3-MEDIUM", "5-LOW", "2-HIGH")) for k in range(5)},
    **{f"service_visit_{k}_tc_{w}_code_desc": f"tier_m{k + step}" for k in (1, 2, 3) for w, step in (("problem", 1), ("fix", 0))},
    "cust_tenure_days": "CASE WHEN chc_id%9<>0 THEN CAST(n_orders*chc_id%2500 AS STRING) END",
    "promo_rolloff_count_60day": "n_orders%3", "metro_area_desc": "'here'",
}


def _moved(now: str, history: list[str], words=("same", "up", "down")) -> str:
    best = f"greatest({', '.join(history)})"
    return f"CASE WHEN {now} = {best} THEN '{words[0]}' WHEN {now} > {best} THEN '{words[1]}' ELSE '{words[2]}' END"


def _listed(c: str, levels) -> str:
    return f"CASE WHEN upper({c}) IN ({', '.join(repr(x) for x in levels)}) THEN {c} ELSE 'ALL_OTHER' END"


def _rule_block_sql() -> str:
    ranks = ("same", "higher", "lower")
    speed = [_swap(f"speed_m{k}", ("BROADBAND INTERNET ", ""), ("None", "0"), ("GBPS", "000")) for k in range(5)]
    some, none = "upper({}) <> 'NONE'".format, "upper({}) = 'NONE'".format
    flag = "CASE WHEN {} THEN 1 ELSE 0 END".format
    repeat = [f"agent_repeat_{k}_prevDept" for k in (1, 2, 3)]
    dept = "CASE WHEN lower({0}) LIKE '%retention%' THEN 'Retention' WHEN lower({0}) LIKE '%sales%' THEN 'Sales' ELSE {0} END".format
    tier = "CASE " + " ".join(f"WHEN lower({{0}}) LIKE '%{w}%' THEN '{w.upper()}'" for w in ("basic", "economy", "core", "value", "select", "premier")) + " WHEN upper({0}) = 'NONE' THEN {0} ELSE 'ALL_OTHER' END"
    code = "CASE {0} WHEN 'None' THEN 0 WHEN 'BASIC' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'CORE' THEN 3 WHEN 'VALUE' THEN 4 WHEN 'SELECT' THEN 5 WHEN 'PREMIER' THEN 6 ELSE -1 END"
    a = [
        "*", f"{dept('agent_last_dept')} AS agent", *(f"CAST(split_part(split_part({s},'/',1),'-',1) AS DOUBLE) AS sp{k}" for k, s in enumerate(speed)),
        *(f"CASE WHEN baserev_m{k}='None' THEN 0 ELSE CAST(baserev_m{k} AS DOUBLE) END AS rv{k}" for k in range(7)),
        *(f"{tier.format(f'curr_video_tier_desc_m{k}')} AS vt{k}" for k in range(5)), "CAST(cust_tenure_days AS DOUBLE) AS days",
        *(f"{flag(some(f'service_visit_{k}_tc_problem_code_desc'))} AS sv{k}" for k in (1, 2, 3)),
        *(f"{flag(f'{p}_m{k}=' + repr('y'))} AS {s}_{k}" for s, (p, _) in _SVOD.items() for k in (1, 2, 3)),
    ]
    b = [
        "*", *(f"{code.format(f'vt{k}')} AS vc{k}" for k in range(5)), f"CASE WHEN CAST(CAST(sp0 AS BIGINT) AS VARCHAR) IN ({', '.join(repr(x) for x in ('0', '25', '30', '50', '100', '200', '300', '400', '500', '1000'))}) THEN CAST(CAST(sp0 AS BIGINT) AS VARCHAR) ELSE 'ALL_OTHER' END AS speed",
        "CASE WHEN days <= 182 THEN '0_6mon' WHEN days <= 365 THEN '6_12mon' WHEN days <= 730 THEN '12_24mon' WHEN days <= 1825 THEN '24_60mon' WHEN days IS NOT NULL THEN 'morethan_60mon' ELSE 'nan' END AS cust_tenure",
    ]
    video = _moved("vc0", [f"vc{k}" for k in range(1, 5)], ranks)
    outs = {
        **{c: c for c in _KEPT}, "cust_tenure": "cust_tenure", "agent_last_dept": "agent", "speed_m0": "speed", "curr_video_tier_desc_m0": "vt0",
        "ebill_status_desc": "CASE WHEN upper(ebill_status_desc) IN ('EBILL AND PRINT STATEMENT','EBILL ONLY') THEN 'Ebill' ELSE ebill_status_desc END",
        "ivr_last_dept": f"CASE WHEN upper(ivr_last_dept)='UNKNOWN' THEN 'None' ELSE {dept('ivr_last_dept')} END",
        **{c: _listed(c, ("BILLING", "DATA", "VIDEO", "GENERAL", "RETENTION", "SALES", "APPOINTMENT", "NONE")) for c in ("ivr_last_interactionReason", *(f"ivr_repeat_{k}_prevInteractionReason" for k in (1, 2, 3)))},
        "ivr_last_ivrInteractionEndResult": "CASE WHEN upper(ivr_last_ivrInteractionEndResult)='NONE' THEN 'Success' ELSE ivr_last_ivrInteractionEndResult END",
        **{c: f"CASE WHEN upper({c})='UNKNOWN' THEN 'None' ELSE {_listed(c, ('CUSTOMER SERVICE REP', 'TECHNICAL SERVICE REP', 'NONE'))} END" for c in (f"ivr_repeat_{k}_prevDept" for k in (1, 2, 3))},
        "speed_change_m4m0": _moved("sp0", [f"sp{k}" for k in range(1, 5)], ranks),
        **{f"{s}_change_m3m1": _moved(f"{s}_1", [f"{s}_2", f"{s}_3"]) for s in _SVOD},
        "baserev_change_m6m0": _moved("rv0", [f"rv{k}" for k in range(1, 7)]),
        "video_tier_change_m4m0": f"CASE WHEN {video} <> 'same' AND (vc0 = -1 OR greatest(vc1,vc2,vc3,vc4) = -1) THEN 'OTHER' ELSE {video} END",
        "ov_tier_change_m4m0": "CASE WHEN " + " AND ".join(f"curr_ov_tier_desc_m0 = curr_ov_tier_desc_m{k}" for k in range(1, 5)) + " THEN 0 ELSE 1 END",
        **{f"{p}_m{k}": f"CASE WHEN upper({p}_m{k}) IN ('NO OFFER','NONE') THEN 0 ELSE 1 END" for p in _OFFERS for k in range(5)},
        **{c: flag(some(c)) for c in (f"service_visit_{k}_tc_{w}_code_desc" for k in (1, 2, 3) for w in ("problem", "fix"))},
        "promo_rolloff_count_60day": "least(promo_rolloff_count_60day, 1)",
        "cust_equip_class_speedm0": "cust_equip_class||'_'||speed", "tenure_productclass": "cust_tenure||'_'||product_class_desc", "tenure_income": "cust_tenure||'_'||ecohort_income_range_desc",
        "rateevent_baserevchange": flag("rate_event_count_60day > 0 AND rv0 <> rv1"),
        **{f"agentcall_and_repeat{k + 1}": flag(" AND ".join([some("agent"), some(repeat[k]), *(none(x) for x in repeat[k + 1 : k + 2])])) for k in range(3)},
        "servicevisit_once": flag("sv1=1 AND sv2=0"), "servicevisit_twotimes": flag("sv2=1 AND sv3=0"), "servicevisit_threetimes": flag("sv3=1"),
        "agentcall_servicevisit": flag(some("agent") + " AND sv1=1"),
        **{f"agentlastdep_{n}distress": f"agent||'_'||CASE WHEN {f} > 0 THEN 1 ELSE 0 END" for n, f in _DISTRESS.items()},
    }
    given = ", ".join(f"{v} AS {n}" for n, v in _FIXED_LINE.items())
    return with_views("v4", f"f AS (SELECT {given} FROM v4)", f"a AS (SELECT {', '.join(a)} FROM f)", f"b AS (SELECT {', '.join(b)} FROM a)", select="SELECT " + ", ".join(f"{v} AS {n}" for n, v in outs.items()) + " FROM b")


query("rule_block", _rule_block_sql())(lambda s, sf: rules.rule_block(fx.text_history(s, sf).selectExpr(*(f"{v} AS {n}" for n, v in _FIXED_LINE.items()))))


query(
    "tenure_bucket",
    with_views(
        "v1",
        select="""SELECT chc_id, dt, CASE WHEN tenure*30<=182 THEN '0_6mon' WHEN tenure*30<=365 THEN '6_12mon' WHEN tenure*30<=730 THEN '12_24mon'
  WHEN tenure*30<=1825 THEN '24_60mon' ELSE 'morethan_60mon' END AS bucket, CASE WHEN orders_6m > 0 THEN 1 ELSE orders_6m END AS capped FROM v1""",
    ),
)(
    lambda s, sf: fx.cust_month(s, sf).select(
        "chc_id", "dt", rules.tenure_bucket(F.col("tenure") * 30).alias("bucket"), F.when(F.col("orders_6m") > 0, 1).otherwise(F.col("orders_6m")).alias("capped")
    )
)

query(
    "feature_cross",
    with_views("v1", select="SELECT chc_id, dt, segment || '_' || nation AS seg_nation, product || '_' || area || '_' || drform AS three FROM v1"),
)(
    lambda s, sf: fx.cust_month(s, sf).select(
        "chc_id", "dt", rules.cross(F.col("segment"), F.col("nation")).alias("seg_nation"), rules.cross(F.col("product"), F.col("area"), F.col("drform")).alias("three")
    )
)

query(
    "competition_label",
    with_views(
        "v4",
        select="""SELECT chc_id, coalesce(nullif(concat_ws(',', CASE WHEN tier_m0='1-URGENT' THEN 'FIBER' END, CASE WHEN tier_m1='1-URGENT' THEN 'DOCSIS_3_0' END,
  CASE WHEN tier_m2='1-URGENT' THEN 'DOCSIS_3_1' END, CASE WHEN tier_m3='1-URGENT' THEN 'COAX' END), ''), 'NONE') AS competition FROM v4""",
    ),
)(
    lambda s, sf: fx.text_history(s, sf).select(
        "chc_id",
        rules.competition_label(
            {n: fc.flag(F.col(f"tier_m{k}") == "1-URGENT") for k, n in enumerate(["FIBER", "DOCSIS_3_0", "DOCSIS_3_1", "COAX"])}
        ).alias("competition"),
    )
)

# --- numbers in a row and bins ---

query(
    "row_aggregates",
    with_views(
        "v1",
        select="""SELECT chc_id, dt, greatest(rev_m0,rev_m1,rev_m2,rev_m3) AS top,
  round(coalesce(rev_m0,0)+coalesce(rev_m1,0)+coalesce(rev_m2,0)+coalesce(rev_m3,0),2) AS total,
  round((coalesce(rev_m0,0)+coalesce(rev_m1,0)+coalesce(rev_m2,0)+coalesce(rev_m3,0)) / (CASE WHEN rev_m0 IS NULL THEN 0 ELSE 1 END+CASE WHEN rev_m1 IS NULL THEN 0 ELSE 1 END+CASE WHEN rev_m2 IS NULL THEN 0 ELSE 1 END+CASE WHEN rev_m3 IS NULL THEN 0 ELSE 1 END), 4) AS mean,
  CASE greatest(rev_m0,rev_m1,rev_m2,rev_m3) WHEN rev_m0 THEN 'M0' WHEN rev_m1 THEN 'M1' WHEN rev_m2 THEN 'M2' WHEN rev_m3 THEN 'M3' END AS best FROM v1""",
    ),
)(lambda s, sf: _row_aggregates(fx.cust_month(s, sf)))


def _row_aggregates(df):
    rev = [F.col(f"rev_m{k}") for k in range(4)]
    return df.select(
        "chc_id", "dt", fc.row_max(rev).alias("top"), F.round(fc.row_sum(rev), 2).alias("total"),
        F.round(fc.row_mean(rev), 4).alias("mean"), fc.row_argmax({f"M{k}": c for k, c in enumerate(rev)}).alias("best"),
    )


def _bins(name, source, key, x, edges_labels):
    sql = with_views(source, select=f"SELECT {key}, " + ", ".join(f"{cut_sql(x[n], *el)} AS {n}" for n, el in edges_labels.items()) + f" FROM {source}")
    view = {"v1": fx.cust_month, "v4": fx.text_history}[source]
    cols = key.split(", ")
    query(name, sql)(lambda s, sf: view(s, sf).select(*cols, *[fc.cut(F.expr(x[n]), *el).alias(n) for n, el in edges_labels.items()]))


_bins(
    "tenure_bins", "v1", "chc_id, dt", {f"tenure_{k}m": "tenure" for k in (3, 1, 6)},
    {f"tenure_{k}m": ca.step_bins(12, 96, k, "Months", "Under 12 Months") for k in (3, 1, 6)},
)
_PAY = "rev_m0/2000"
_CHG, _CHGP = "(rev_m0-rev_m1)/5000", "(rev_m0-rev_m1)/10000"
_bins(
    "payment_bins", "v1", "chc_id, dt",
    {"pay_25": _PAY, "pay_10": _PAY, "chg_5": _CHG, "chg_10": _CHG, "chg_2p": _CHGP, "chg_5p": _CHGP},
    {
        "pay_25": ca.payment_bins(25), "pay_10": ca.payment_bins(10), "chg_5": ca.change_bins(50, 5, "Dollars"),
        "chg_10": ca.change_bins(50, 10, "Dollars", last=5), "chg_2p": ca.change_bins(20, 2, "Pct"), "chg_5p": ca.change_bins(30, 5, "Pct"),
    },
)
_bins("call_bins", "v1", "chc_id, dt", {"wide": "orders_6m", "narrow": "orders_6m"}, {"wide": ca.call_bins(True), "narrow": ca.call_bins(False)})

_BANDS = {"AUTOMOBILE": "a.$1-$14,999", "BUILDING": "d.$35k-$49", "FURNITURE": "g.$100k-$124", "HOUSEHOLD": "l.$250k+", "MACHINERY": "UNKNOWN"}
_MID = "CASE segment WHEN 'AUTOMOBILE' THEN 8000 WHEN 'BUILDING' THEN 43000 WHEN 'FURNITURE' THEN 113000 WHEN 'HOUSEHOLD' THEN 300000 WHEN 'MACHINERY' THEN 63000 END"
_MEAN = "(coalesce(rev_m0,0)+coalesce(rev_m1,0)+coalesce(rev_m2,0)) / (CASE WHEN rev_m0 IS NULL THEN 0 ELSE 1 END+CASE WHEN rev_m1 IS NULL THEN 0 ELSE 1 END+CASE WHEN rev_m2 IS NULL THEN 0 ELSE 1 END)"

query(
    "payment_income_ratio",
    with_views(
        "v1", f"r AS (SELECT chc_id, dt, round(1200 * ({_MEAN}) / ({_MID}), 6) AS ratio FROM v1)",
        select=f"SELECT chc_id, dt, ratio, {cut_sql('ratio', ca.INCOME_SHARE_EDGES, ca.INCOME_SHARE_LABELS)} AS bin FROM r",
    ),
)(
    lambda s, sf: fx.cust_month(s, sf)
    .select("chc_id", "dt", F.round(ca.payment_income_ratio([F.col(f"rev_m{k}") for k in range(3)], fc.map_levels(F.col("segment"), _BANDS)), 6).alias("ratio"))
    .select("chc_id", "dt", "ratio", fc.cut(F.col("ratio"), ca.INCOME_SHARE_EDGES, ca.INCOME_SHARE_LABELS).alias("bin"))
)

# --- column plumbing ---

query("scan_snapshot", with_views("v1", select="SELECT chc_id, dt, tenure, product, rev_m0 FROM v1"))(
    lambda s, sf: fx.cust_month(s, sf).select("chc_id", "dt", "tenure", "product", "rev_m0")
)
query("project_atts", with_views("v1", select="SELECT chc_id, tenure, product FROM v1 WHERE dt = 200003"))(
    lambda s, sf: co.project(fx.cust_month(s, sf).filter("dt = 200003"), ["tenure", "product"])
)
query("blank_to_null", with_views("v5", select="SELECT chc_id, CASE WHEN trim(segment) <> '' THEN segment END AS segment, priority FROM v5"))(
    lambda s, sf: prep.blanks_to_null(fx.wide(s, sf)).select("chc_id", "segment", "priority")
)
_NUMS = ["status", "price", "price_x2", "price_dup", "acctbal_gap", "mostly_missing", "const_num", "yr", "mon"]
query("select_num", with_views("v5", select=f"SELECT chc_id, {', '.join(_NUMS)} FROM v5"))(lambda s, sf: pc.select_numeric(fx.wide(s, sf), ["chc_id"]))
query("select_cat", with_views("v5", select="SELECT chc_id, const_cat, priority, priority_dup, segment, nation FROM v5"))(
    lambda s, sf: pc.select_categorical(fx.wide(s, sf), ["chc_id"])
)
query("rename_prefix", with_views("v5", select="SELECT chc_id, price AS Original_price_raw, yr AS Original_yr_raw, priority AS Original_priority_raw FROM v5"))(
    lambda s, sf: pc.rename_all(fx.wide(s, sf).select("chc_id", "price", "yr", "priority"), "Original", "raw", ["chc_id"])
)
query(
    "sanitize_levels",
    "SELECT DISTINCT x AS original, replace(replace(regexp_replace(x,'[^A-Za-z0-9+ ]','','g'),'+','PLUS'),' ','SPACE') AS cleaned FROM (SELECT o_orderpriority || '_' || o_orderstatus || '+' AS x FROM orders)",
)(
    lambda s, sf: fx.table(s, sf, "orders").select(F.concat("o_orderpriority", F.lit("_"), "o_orderstatus", F.lit("+")).alias("original")).distinct()
    .select("original", pc.clean_text(F.col("original")).alias("cleaned"))
)
query("align_columns", with_views("v5", select="SELECT chc_id, yr, 0 AS not_here, price, 0 AS nor_this FROM v5"))(
    lambda s, sf: pc.align_to(fx.wide(s, sf), ["yr", "not_here", "price", "nor_this"], ["chc_id"])
)


def _name_map(s, sf):
    df = prep.blanks_to_null(fx.wide(s, sf))
    return pc.name_map(s, prep.level_lists(df, ["priority", "segment"]), ["price", "mon"], "::")


query(
    "feature_name_map",
    with_views(
        "v5", "p AS (SELECT DISTINCT 'priority' AS a, priority AS l FROM v5 UNION SELECT DISTINCT 'segment', segment FROM v5 WHERE trim(segment) <> '')",
        select="""SELECT a AS attribute, a||'_'||l AS attribute_level, a||'::'||l AS with_sep, replace(regexp_replace(a||'::'||l,'[^A-Za-z0-9+ ]','','g'),' ','SPACE') AS model_name FROM p
UNION ALL SELECT c, c, c, c FROM (SELECT unnest(['price','mon']) AS c)""",
    ),
)(_name_map)

# --- files ---


def _csv(s, sf):
    df = fx.table(s, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"))
    path = new_folder(s, "csv")
    files.export(df, path, "csv", gzip=True)
    return files.read_export(s, path, files.schema_of({"c_custkey": "INT64", "c_name": "STRING", "c_acctbal": "FLOAT64", "c_mktsegment": "STRING"}))


query("csv_roundtrip", "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment FROM customer")(_csv)


def _json(s, sf):
    df = fx.calls(s, sf).withColumn("value", F.when(F.col("event_type") != "view", F.col("value")))
    path = new_folder(s, "json")
    files.export(df, path, "json", gzip=True)
    return files.read_export(s, path, files.schema_of({"chc_id": "INT64", "event_type": "STRING", "reportdate": "DATE", "value": "FLOAT64"}), "json")


query("json_roundtrip", with_views("v3", select="SELECT chc_id, event_type, reportdate, CASE WHEN event_type <> 'view' THEN value END AS value FROM v3"))(_json)


def _append(s, sf):
    orders = fx.table(s, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    path = new_folder(s, "table")
    files.write_table(orders.filter("yr < 1998"), path, truncate=True, partition_by=("yr",))
    files.write_table(orders.filter("yr >= 1998"), path, truncate=False, partition_by=("yr",))
    return s.read.schema("o_orderkey bigint, o_orderstatus string, yr int").parquet(path)


query("append_then_read", "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS yr FROM orders")(_append)
_TYPES = {
    "chc_id": "INT64", "dt": "INT64", "tenure": "INT64", "drform": "STRING", "vol_pend_disco": "STRING", "pending_drform": "STRING", "pending_mover": "STRING",
    "product": "STRING", "rev_m0": "FLOAT64", "rev_m1": "FLOAT64", "rev_m2": "FLOAT64", "rev_m3": "FLOAT64", "orders_m0": "INT64", "orders_6m": "INT64",
    "acctbal": "FLOAT64", "segment": "STRING", "nation": "STRING", "area": "STRING",
}
query(
    "schema_report",
    with_views("v1", select=" UNION ALL ".join(f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_values FROM v1" for i, (c, t) in enumerate(_TYPES.items()))),
)(lambda s, sf: files.schema_report(fx.cust_month(s, sf), counts=True))


def _artifact(s, sf):
    """Fitted stages of two kinds, stored, loaded and applied without the table they were fitted on."""
    from stayflow.operators import numeric as nu
    from stayflow.operators.stage import load_fitted, union

    df = fx.wide(s, sf).select("chc_id", "price", "mon", "priority")
    path = new_folder(s, "fits")
    cols = ["price", "mon"]
    made = {"MinMax": nu.minmax(df, cols), "Standard": nu.standard(df, cols), "MaxAbs": nu.maxabs(df, cols), "Log1p": nu.log1p(cols)}
    union(*[f.renamed(n) for n, f in made.items()]).save(s, f"{path}/numbers")
    ca.fit_encoder(df, ["priority"], "pct", prefix="pct").save(f"{path}/levels")
    numbers, levels = load_fitted(s, f"{path}/numbers"), ca.LevelCodes.load(s, f"{path}/levels")
    out = levels.apply(numbers.apply(df, ["chc_id", "priority"]))
    return out.select("chc_id", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("chc_id", "priority")])


query(
    "artifact_roundtrip",
    with_views(
        "v5",
        """m AS (SELECT min(price) AS a, max(price) AS b, CAST(min(mon) AS DOUBLE) AS c, CAST(max(mon) AS DOUBLE) AS d, avg(price) AS pm, stddev_pop(price) AS ps,
  avg(mon) AS mm, stddev_pop(mon) AS ms, max(abs(price)) AS px, max(abs(mon)) AS mx, count(*) AS n FROM v5)""",
        "l AS (SELECT priority, count(*) AS k FROM v5 GROUP BY priority)",
        select="""SELECT chc_id, round((price-a)/(b-a),6) AS MinMax_price, round((mon-c)/(d-c),6) AS MinMax_mon, round((price-pm)/ps,6) AS Standard_price, round((mon-mm)/ms,6) AS Standard_mon,
  round(price/px,6) AS MaxAbs_price, round(CAST(mon AS DOUBLE)/mx,6) AS MaxAbs_mon, round(ln(1+price),6) AS Log1p_price, round(ln(1+CAST(mon AS DOUBLE)),6) AS Log1p_mon,
  round(CAST(k AS DOUBLE)/n,6) AS pct_priority FROM v5 JOIN l USING (priority), m""",
    ),
)(_artifact)
