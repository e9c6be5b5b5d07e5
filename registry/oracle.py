"""The queries again, as independent SQL for DuckDB over the same tables."""

from __future__ import annotations

from .inputs import SNIPPETS
from .queries import AS_OF, DAU_METRICS, DAY, RETENTION_AS_OF, VERSION_COLUMNS

K = "cast(json_extract_string(props, '$.k') as bigint)"


def uid(x: str) -> str:
    return f"'usr_' || lpad(cast({x} as varchar), 16, '0')"


def bands(x: str, *steps, last) -> str:
    def text(label) -> str:
        return f"'{label}'" if isinstance(label, str) else str(label)

    tests = " ".join(f"when {x} < {bound} then {text(label)}" for bound, label in steps)
    return f"case {tests} else {text(last)} end"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


MESSAGE = "event_type in ('view', 'click', 'purchase')"
PLATFORM = bands("value", (15, "web"), (35, "ios"), (70, "android"), last="api")

_SNIPPET_CASE = " ".join(f"when '{s}' then '{t}'" for s, t in SNIPPETS.items())

# Named subqueries: name -> (SQL, names it builds on).
PARTS: dict[str, tuple[str, list[str]]] = {
    "ev": (f"select *, {K} as k from events", []),
    "conv": (
        f"""select cast(event_id as varchar) as event_id,
            case when {MESSAGE} then 'message_sent' when event_type = 'signup' then 'session_start'
                 else 'conversation_rated' end as event_type,
            ts as event_timestamp, {uid('user_id')} as user_id,
            'sess_' || cast(user_id as varchar) || '_' || cast(cast(ts as date) as varchar) as session_id,
            {bands('k', (40, 'gpt-4o'), (65, 'gpt-4o-mini'), (80, 'gpt-4-turbo'),
                   (90, 'gpt-3.5-turbo'), (96, 'o1-preview'), last='o1-mini')} as model_id,
            {PLATFORM} as platform,
            case when {MESSAGE} then 'user' end as message_role,
            case when {MESSAGE} then 10 + cast(floor(value * 40) as bigint) end as input_tokens,
            case when {MESSAGE} then 50 + k * 37 end as output_tokens,
            case when {MESSAGE} then 60 + cast(floor(value * 40) as bigint) + k * 37 end as total_tokens,
            case when {MESSAGE} then 100 + cast(floor(value * 10) as bigint) end as latency_ms,
            case when event_type = 'error' then k end as feedback_text_length,
            case when {MESSAGE} then '[EMAIL_REDACTED]' end as mail_mark,
            case when {MESSAGE} then 'mail u' || cast(user_id as varchar)
                 || '@mail.example.com host 10.0.' || cast(k as varchar) || '.7' end as message_text
            from ev""",
        ["ev"],
    ),
    "conv_raw": (
        """select * from conv union all by name
           select * replace (event_timestamp + interval 1 second as event_timestamp)
           from conv where event_type = 'conversation_rated'""",
        ["conv"],
    ),
    "conv_latest": (
        """select * from conv_raw
           qualify row_number() over (partition by event_id order by event_timestamp desc) = 1""",
        ["conv_raw"],
    ),
    "api": (
        f"""select cast(event_id as varchar) as event_id, ts as event_timestamp,
            {uid('user_id')} as user_id,
            {bands('value', (20, 'gpt-4o'), (40, 'gpt-4o-mini'), (60, 'gpt-4-turbo'),
                   (90, 'gpt-3.5-turbo'), (150, 'o1-preview'), last='o1-mini')} as model_id,
            {bands('k', (70, 200), (74, 400), (78, 401), (84, 429), (88, 500), (92, 503),
                   (94, 302), (97, 404), last=200)} as http_status_code,
            50 + cast(floor(value * 20) as bigint) as input_tokens,
            100 + k * 29 as output_tokens,
            150 + cast(floor(value * 20) as bigint) + k * 29 as total_tokens,
            100 + cast(floor(value * 10) as bigint) as latency_ms
            from ev where event_type in ('purchase', 'error', 'click')""",
        ["ev"],
    ),
    "bill0": (
        """select *, case when o_orderpriority = '1-URGENT' then 'subscription_created'
               when o_orderpriority = '2-HIGH' then 'upgrade'
               when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P' then 'downgrade'
               when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then 'refund'
               else 'payment_processed' end as event_type from orders""",
        [],
    ),
    "bill": (
        f"""select cast(o_orderkey as varchar) as event_id, event_type,
            o_orderdate as event_timestamp, {uid('o_custkey')} as user_id,
            {bands('o_totalprice', (100000, 'plan_free'), (350000, 'plan_plus'), last='plan_enterprise')}
                as plan_id,
            case when event_type <> 'downgrade' then cast(o_totalprice as decimal(18,2)) end as amount_usd,
            case when event_type = 'payment_processed' then
                 case o_orderstatus when 'F' then 'succeeded' when 'O' then 'pending' else 'failed' end
            end as payment_status
            from bill0""",
        ["bill0"],
    ),
    "uev": (
        f"""select cast(event_id as varchar) as event_id,
            case event_type when 'signup' then 'user_signup' when 'purchase' then 'user_tier_change'
                 else 'user_login' end as event_type,
            ts as timestamp, {uid('user_id')} as user_id,
            case when event_type = 'signup' then md5('u' || cast(user_id as varchar)) end as email_hash,
            case when event_type = 'signup' then 'User ' || cast(user_id as varchar) end as display_name,
            case when event_type = 'signup' then {bands('k', (60, 'US'), (80, 'DE'), last='JP')} end
                as country_code,
            case when event_type = 'signup'
                 then {bands('k', (70, 'free'), (95, 'plus'), last='enterprise')} end as user_tier,
            case when event_type = 'signup' then {PLATFORM} end as platform,
            case when event_type = 'signup' and k >= 95 then 'org_' || cast(k as varchar) end
                as organization_id,
            case when event_type = 'purchase'
                 then {bands('value', (40, 'free'), (120, 'plus'), last='enterprise')} end as new_tier
            from ev where event_type in ('view', 'signup', 'purchase')""",
        ["ev"],
    ),
    "changes": (
        """select user_id, email_hash, display_name, country_code,
            coalesce(user_tier, new_tier) as user_tier, organization_id, platform,
            case when event_type = 'user_signup' then timestamp end as signup_date,
            case when event_type = 'user_signup' then 'active' end as account_status,
            timestamp as changed_at
            from uev where event_type in ('user_signup', 'user_tier_change')""",
        ["uev"],
    ),
    "cur": (
        f"""select {uid('c_custkey')} as user_id, md5('u' || cast(c_custkey as varchar)) as email_hash,
            c_name as display_name, lpad(cast(c_nationkey as varchar), 2, '0') as country_code,
            case c_mktsegment when 'AUTOMOBILE' then 'plus' when 'FURNITURE' then 'enterprise'
                 else 'free' end as user_tier,
            case when c_mktsegment = 'FURNITURE' then 'org_' || cast(c_nationkey as varchar) end
                as organization_id,
            {bands('c_acctbal', (2500, 'web'), (5000, 'ios'), (7500, 'android'), last='api')} as platform,
            cast(date '2024-01-01' + cast(floor(c_acctbal / 350) as integer) as timestamp) as signup_date,
            'active' as account_status, timestamp '2023-07-01' as valid_from,
            cast(null as timestamp) as valid_to, true as is_current, c_acctbal
            from customer""",
        [],
    ),
    "dim": (
        """select * exclude (c_acctbal) from cur union all by name
           select * exclude (c_acctbal) replace ('free' as user_tier,
               timestamp '2023-01-01' as valid_from, timestamp '2023-07-01' as valid_to,
               false as is_current) from cur where c_acctbal >= 5000""",
        ["cur"],
    ),
    "batch": (
        """select * from changes union all by name
           select * exclude (valid_from, valid_to, is_current, c_acctbal),
               timestamp '2023-12-01' as changed_at from cur where user_tier = 'plus'""",
        ["changes", "cur"],
    ),
    # The merge as one chain per user: the open version first, then the changes.
    "chain0": (
        """select user_id, email_hash, display_name, country_code, user_tier, organization_id,
               platform, signup_date, account_status, valid_from as since, false as incoming from cur
           union all by name
           select * exclude (changed_at), changed_at as since, true as incoming from batch""",
        ["cur", "batch"],
    ),
    "chain1": (
        """select user_id, since, incoming, """
        + ", ".join(
            f"last_value({c} ignore nulls) over u as {c}"
            for c in (
                "email_hash",
                "display_name",
                "country_code",
                "user_tier",
                "organization_id",
                "platform",
                "signup_date",
                "account_status",
            )
        )
        + """, first_value(incoming) over u as is_new_user from chain0
           window u as (partition by user_id order by since rows unbounded preceding)""",
        ["chain0"],
    ),
    "chain2": (
        """select *, lag(since) over u is null
               or user_tier is distinct from lag(user_tier) over u
               or country_code is distinct from lag(country_code) over u
               or display_name is distinct from lag(display_name) over u
               or organization_id is distinct from lag(organization_id) over u
               or account_status is distinct from lag(account_status) over u as is_kept
           from chain1 window u as (partition by user_id order by since)""",
        ["chain1"],
    ),
    "versions": (
        """select * exclude (since, is_kept), since as valid_from,
               lead(since) over (partition by user_id order by since) as valid_to
           from chain2 where is_kept""",
        ["chain2"],
    ),
    "merged": (
        """select v.user_id, email_hash, display_name, country_code, user_tier, organization_id,
               platform, signup_date, account_status, valid_from, valid_to,
               valid_to is null as is_current,
               case when incoming and is_new_user then 'new_key' when incoming then 'new_version'
                    when valid_to is not null then 'expired'
                    when b.user_id is not null then 'unchanged' else 'untouched' end as change_kind
           from versions v left join (select distinct user_id from batch) b on v.user_id = b.user_id
           union all by name
           select *, 'history' as change_kind from dim where not is_current""",
        ["versions", "batch", "dim"],
    ),
    "safety": (
        f"""select cast(event_id as varchar) as event_id, ts as event_timestamp,
            {uid('user_id')} as user_id,
            {bands('k', (20, 'prompt_injection'), (35, 'jailbreak_attempt'),
                   (55, 'content_policy_violation'), (70, 'rate_limit_abuse'),
                   (78, 'credential_stuffing'), (88, 'automated_scraping'),
                   (95, 'harassment_content'), last='illegal_content_request')} as violation_type,
            {bands('value', (25, 'low'), (60, 'medium'), (120, 'high'), last='critical')} as severity,
            (300 + k * 7) / 1000.0::double as confidence_score,
            greatest(1, cast(floor(value / 10) as bigint)) as user_violation_count_30d
            from ev where event_type = 'error'""",
        ["ev"],
    ),
    "quar": (
        """select user_id, violation_type, event_timestamp + interval 2 hour as quarantined_at,
            case when confidence_score < 0.4::double then null
                 when confidence_score < 0.6::double then 'confirmed_abuse'
                 when confidence_score < 0.8::double then 'false_positive' else 'released' end
                as review_outcome,
            confidence_score < 0.6::double as is_active
            from safety where severity = 'critical'""",
        ["safety"],
    ),
    "runs": (
        """select case when event_type in ('purchase', 'signup') then 'daily_batch'
                else 'hourly_safety' end as job, ts as run_at,
            case when k < 8 then 'failed' else 'success' end as status, value as duration_minutes
            from ev""",
        ["ev"],
    ),
    "txt": (
        f"""select doc_id, coalesce(text, '') || (case source {_SNIPPET_CASE} else '' end) as text
            from documents""",
        [],
    ),
}


def _needed(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for one in [*_needed(PARTS[name][1]), name]:
            if one not in out:
                out.append(one)
    return out


def sql(body: str, *names: str) -> str:
    ctes = ", ".join(f"{n} as ({PARTS[n][0]})" for n in _needed(list(names)))
    return f"with {ctes} {body}" if ctes else body


EPOCH = "(epoch_us(event_timestamp) // 1000000)"
CENTS = "cast(cast({} as decimal(18,2)) as double)"


def sessions(gap_seconds: int) -> str:
    """Subquery: conv with its session number, by lag and running sum."""
    return f"""(select *, sum(opens) over (partition by user_id order by event_timestamp) as n from (
        select *, case when lag({EPOCH}) over (partition by user_id order by event_timestamp) is null
            or {EPOCH} - lag({EPOCH}) over (partition by user_id order by event_timestamp) > {gap_seconds}
            then 1 else 0 end as opens from conv))"""


SESSION_ID = (
    "user_id || '_sess_' || repeat('0', greatest(0, 6 - length(cast(n as varchar)))) || cast(n as varchar)"
)


def versions_of(kind: str | None) -> str:
    columns = ", ".join(
        f"{stamp(c)} as {c}" if c.startswith("valid_") else c for c in VERSION_COLUMNS
    )
    where = f" where change_kind = '{kind}'" if kind else ""
    return f"select {columns} from merged{where}"


CATEGORY = """case when http_status_code = 200 then 'success'
    when http_status_code = 429 then 'rate_limited'
    when http_status_code between 400 and 499 then 'client_error'
    when http_status_code between 500 and 599 then 'server_error' else 'unknown' end"""

COST = """case model_id
    when 'gpt-4o' then (input_tokens * 2.5::double + output_tokens * 10::double) / 1000000
    when 'gpt-4o-mini' then (input_tokens * 0.15::double + output_tokens * 0.6::double) / 1000000
    when 'gpt-4-turbo' then (input_tokens * 10::double + output_tokens * 30::double) / 1000000
    when 'gpt-3.5-turbo' then (input_tokens * 0.5::double + output_tokens * 1.5::double) / 1000000
    else 0::double end"""

COST_ALL = COST.replace(
    "else 0",
    """when 'o1-preview' then (input_tokens * 15::double + output_tokens * 60::double) / 1000000
    when 'o1-mini' then (input_tokens * 3::double + output_tokens * 12::double) / 1000000 else 0""",
)

IMPACT = """case when event_type in ('subscription_created', 'payment_processed', 'upgrade')
    then 'positive' when event_type = 'refund' then 'negative'
    when event_type = 'downgrade' then 'at_risk' else 'neutral' end"""

FOLLOWUP = "coalesce(event_type = 'payment_processed' and payment_status = 'failed', false)"


# Patterns of personal data and what stands for them.
PERSONAL = [
    (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL_REDACTED]"),
    (r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", "[PHONE_REDACTED]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN_REDACTED]"),
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[IP_REDACTED]"),
]


def masked(x: str) -> str:
    for pattern, mark in PERSONAL:
        x = f"regexp_replace({x}, '{pattern}', '{mark}', 'g')"
    return x


# Pattern, weight, category; in order of precedence on equal scores.
# Patterns, weights and categories of injection phrases.
INJECTION = [
    (r"ignore\s+(all\s+)?previous\s+instructions", 0.9, "ignore_instructions"),
    (r"ignore\s+(all\s+)?prior\s+instructions", 0.9, "ignore_instructions"),
    (r"you\s+are\s+now\s+", 0.7, "role_override"),
    (r"pretend\s+(you\s+are|to\s+be)\s+", 0.7, "role_override"),
    (r"act\s+as\s+if\s+you", 0.6, "role_override"),
    (r"system:\s*", 0.8, "system_prompt_leak"),
    (r"<\|im_start\|>system", 0.95, "delimiter_attack"),
    (r"<\|endoftext\|>", 0.85, "delimiter_attack"),
    (r"ADMIN\s+OVERRIDE", 0.9, "authority_claim"),
    (r"DAN\s+mode", 0.85, "jailbreak"),
    (r"do\s+anything\s+now", 0.8, "jailbreak"),
    (r"developer\s+mode", 0.75, "jailbreak"),
    (r"bypass\s+(safety|content)\s+filter", 0.9, "filter_bypass"),
    (r"base64\s+decode", 0.6, "encoding_bypass"),
    (r"\\x[0-9a-fA-F]{2}", 0.5, "encoding_bypass"),
]

_HITS = ", ".join(
    f"least({w}::double * len(regexp_extract_all(text, '(?i){p}')), 1.0::double) as s{i}"
    for i, (p, w, _) in enumerate(INJECTION)
)
_BEST = "greatest(" + ", ".join(f"s{i}" for i in range(len(INJECTION))) + ")"
_FIRST = " ".join(f"when s{i} = best then '{c}'" for i, (_, _, c) in enumerate(INJECTION))


def injected(source: str) -> str:
    """Subquery: source with injection_risk_score and injection_pattern."""
    return f"""(select *, best as injection_risk_score,
        case when best = 0 then 'none' {_FIRST} end as injection_pattern
        from (select *, {_BEST} as best from (select *, {_HITS} from {source})))"""


FLAGS = """select {period} a.user_id, bool_or(a.via_api) as api, bool_or(d.user_tier = 'free') as free,
    bool_or(d.user_tier = 'plus') as plus, bool_or(d.user_tier = 'enterprise') as enterprise,
    bool_or(d.platform = 'web') as web, bool_or(d.platform in ('ios', 'android')) as mobile,
    bool_or(cast(d.signup_date as date) = a.event_date) as is_new
    from (select user_id, cast(event_timestamp as date) as event_date, false as via_api from conv
          union all
          select user_id, cast(event_timestamp as date), true from api) a
    left join (select * from dim where is_current) d on a.user_id = d.user_id
    {where} group by {period} a.user_id"""

DAU_COUNTS = """count(*) as total_dau, count(*) filter (where free) as dau_free,
    count(*) filter (where plus) as dau_plus, count(*) filter (where enterprise) as dau_enterprise,
    count(*) filter (where web) as dau_web, count(*) filter (where mobile) as dau_mobile,
    count(*) filter (where api) as dau_api, count(*) filter (where is_new) as new_users_today,
    count(*) - count(*) filter (where is_new) as returning_users"""

DAU_DAY = f"""select '{DAY}' as event_date, {DAU_COUNTS} from (
    {FLAGS.format(period='', where=f"where a.event_date = date '{DAY}'")})"""
DAU_ALL = f"""select cast(event_date as varchar) as event_date, {DAU_COUNTS} from (
    {FLAGS.format(period='a.event_date,', where='')}) group by event_date"""


def engagement(where: str) -> str:
    return f"""select cast(w.week_start as varchar) as week_start, w.user_tier, total_sessions,
        total_messages, avg_tokens_per_message, p50_latency_ms, p95_latency_ms, p99_latency_ms,
        unique_models_used, round(o.per_session, 6) as avg_messages_per_session from (
        select week_start, user_tier, count(distinct session_id) as total_sessions,
            count(*) as total_messages, round(avg(total_tokens), 6) as avg_tokens_per_message,
            quantile_disc(latency_ms, 0.5) as p50_latency_ms,
            quantile_disc(latency_ms, 0.95) as p95_latency_ms,
            quantile_disc(latency_ms, 0.99) as p99_latency_ms,
            count(distinct model_id) as unique_models_used
        from (select c.*, d.user_tier, cast(date_trunc('week', event_timestamp) as date) as week_start
              from conv c left join (select * from dim where is_current) d on c.user_id = d.user_id
              where event_type = 'message_sent' {where})
        group by all) w join (
        select week_start, avg(n) as per_session from (
            select cast(date_trunc('week', event_timestamp) as date) as week_start, session_id,
                count(*) as n from conv where event_type = 'message_sent' {where} group by all)
        group by week_start) o on w.week_start = o.week_start"""


def revenue(period: str, where: str = "", only_succeeded: bool = False) -> str:
    amount = "amount_usd"
    if only_succeeded:
        amount = """case when event_type <> 'payment_processed' or payment_status = 'succeeded'
            then amount_usd end"""

    def total(*kinds: str) -> str:
        listed = ", ".join(f"'{x}'" for x in kinds)
        money = f"coalesce(sum(case when event_type in ({listed}) then {amount} end), 0)"
        return f"cast({money} as double)"

    def times(kind: str) -> str:
        return f"count(*) filter (where event_type = '{kind}')"

    return f"""select cast({period} as varchar) as month_start,
        {total('payment_processed', 'subscription_created')} as total_revenue_usd,
        {total('subscription_created')} as subscription_revenue_usd,
        {total('payment_processed')} as api_usage_revenue_usd,
        {times('subscription_created')} as new_subscriptions,
        {times('downgrade')} as churned_subscriptions, {times('upgrade')} as upgrades,
        {times('downgrade')} as downgrades, {total('refund')} as refunds_usd,
        cast(coalesce(sum(case when event_type in ('subscription_created', 'payment_processed')
             then {amount} when event_type = 'refund' then -({amount}) end), 0) as double) as mrr_usd
        from bill {where} group by all"""


CONV_DAYS = """select user_id, cast(event_timestamp as date) as event_date,
    count(distinct session_id) as session_count, count(*) as message_count,
    avg(total_tokens) as avg_tokens, count(distinct model_id) as models_used,
    avg(latency_ms) as avg_latency_ms
    from conv where event_type = 'message_sent' group by all"""

API_DAYS = """select user_id, cast(event_timestamp as date) as event_date,
    count(*) as api_call_count, cast(sum(total_tokens) as bigint) as total_api_tokens
    from api where http_status_code = 200 group by all"""


def share(x: str, cap: int) -> str:
    return f"coalesce(least(1.0::double, greatest(0.0::double, {x} / {cap}::double)), 0.0::double)"


BOARD = f"""select '{DAY}' as event_date, s.*, q.* from (
    select count(*) as total_safety_signals,
        count(*) filter (where violation_type = 'prompt_injection') as prompt_injection_attempts,
        count(*) filter (where violation_type = 'jailbreak_attempt') as jailbreak_attempts,
        count(*) filter (where violation_type = 'rate_limit_abuse') as rate_limit_violations,
        count(*) filter (where violation_type = 'content_policy_violation') as content_policy_flags,
        round(avg(confidence_score), 6) as avg_confidence
    from safety where cast(event_timestamp as date) = date '{DAY}') s, (
    select count(*) filter (where is_active) as accounts_quarantined,
        count(*) filter (where review_outcome = 'released') as accounts_released {{extra}}
    from quar {{join}} where cast(quarantined_at as date) = date '{DAY}') q"""

BOARD_EXTRA = """, round(count(*) filter (where review_outcome = 'false_positive')
    / nullif(count(review_outcome), 0)::double, 6) as false_positive_rate,
    round(avg((epoch_us(quarantined_at) - epoch_us(first_signal)) / 1000000::double), 3)
        as mean_time_to_detect_seconds"""
BOARD_JOIN = """left join (select user_id as u, min(event_timestamp) as first_signal from safety
    group by user_id) f on quar.user_id = f.u"""

ZSCORE = """(select s.*, case when sd is not null and sd > 0 and n >= 5
    then abs((user_violation_count_30d - m) / sd) else 0 end as z
    from safety s join (select user_id, avg(user_violation_count_30d) as m,
        stddev_samp(user_violation_count_30d) as sd, count(*) as n from safety group by user_id) g
    on s.user_id = g.user_id)"""

def rates(multiplier: float) -> str:
    return f"""with_counts as (select user_id, count(*) as request_count from api group by user_id)
        select user_id, request_count, request_count > (select coalesce(avg(request_count), 0)
            + {multiplier}::double * coalesce(nullif(stddev_samp(request_count), 0), 1)
            from with_counts) as is_rate_anomaly from with_counts"""


HOURLY = """with_counts as (select user_id, time_bucket(interval 60 minute, event_timestamp) as w,
        count(*) as request_count from api group by all)
    select user_id, strftime(w, '%Y-%m-%d %H:%M:%S.%f') as window_start, request_count,
        request_count > (select avg(request_count) + 5::double
            * coalesce(nullif(stddev_samp(request_count), 0), 1) from with_counts) as is_rate_anomaly
    from with_counts"""


def quarantine(as_of: str, extra: str, held: str) -> str:
    return f"""select p.user_id, m.violation_type, severity, violation_count,
        round(confidence, 6) as confidence_score, {extra} from (
        select user_id, count(*) as violation_count,
            count(*) filter (where severity in ('high', 'critical')) as severe,
            case max(case severity when 'low' then 1 when 'medium' then 2 when 'high' then 3 else 4 end)
                when 1 then 'low' when 2 then 'medium' when 3 then 'high' else 'critical' end as severity,
            max(confidence_score) as confidence,
            bool_or(severity = 'critical' and confidence_score >= 0.7::double) as sure
        from recent group by user_id) p join (
        select user_id, violation_type from (
            select user_id, violation_type, row_number() over (
                partition by user_id order by count(*) desc, violation_type) as place
            from recent group by user_id, violation_type) where place = 1) m on p.user_id = m.user_id
        where (severe >= 5 or sure) {held}"""


def recent(as_of: str) -> str:
    return f"""recent as (select * from safety where event_timestamp < timestamp '{as_of}'
        and event_timestamp >= timestamp '{as_of}' - interval 30 day)"""


def check(topic: str, name: str, count: str, source: str, what: str, allowed: str = "none") -> str:
    """A rule that counts something: there may be none of it, some of it, or one per row (all)."""
    limit = {"none": "0", "some": "1", "all": "total"}[allowed]
    passed = "v >= 1" if allowed == "some" else f"v = {limit}"
    expected = "'at least 1'" if allowed == "some" else f"cast({limit} as varchar)"
    return f"""select '{topic}' as topic, '{name}' as check_name, {passed} as passed, v as actual_value,
        {expected} as expected, v || ' {what} over ' || total || ' rows' as message
        from (select {count} as v, count(*) as total from {source})"""


def broken(condition: str) -> str:
    return f"count(*) filter (where {condition})"


EVENT_KINDS = "('session_start', 'message_sent', 'conversation_rated', 'session_end')"
STATUS_CODES = "(200, 400, 401, 403, 404, 429, 500, 502, 503)"
VALUE_RULES = {
    "conversation_events": [
        ("values_in_set:event_type", f"event_type not in {EVENT_KINDS}", "values that are not listed"),
        ("column_between:input_tokens", "input_tokens not between 0 and 200000", "values beyond 0 to 200000"),
    ],
    "api_usage_events": [
        ("values_in_set:http_status_code", f"http_status_code not in {STATUS_CODES}", "values that are not listed"),
    ],
    "billing_events": [
        ("column_between:amount_usd", "amount_usd not between 0 and 10000", "values beyond 0 to 10000"),
    ],
    "user_events": [
        ("column_matches_regex:user_id", "not regexp_matches(user_id, '^usr_[a-z0-9]{16}$')", "values of another form"),
    ],
}


def suite(topic: str, source: str) -> list[str]:
    rules = [("not_empty", "count(*)", "rows found", "some"), ("unique:event_id", "count(distinct event_id)", "different values", "all")]
    filled = ["event_id"] if topic == "billing_events" else ["event_id", "user_id"]
    rules += [(f"no_nulls:{c}", broken(f"{c} is null"), "missing values", "none") for c in filled]
    if topic == "conversation_events":
        rules += [(f"column_exists:{c}", "1", "such columns", "some") for c in ("event_id", "user_id", "timestamp", "event_type")]
    rules += [(name, broken(condition), what, "none") for name, condition, what in VALUE_RULES[topic]]
    return [check(topic, name, count, source, what, allowed) for name, count, what, allowed in rules]


QUALITY = " union all ".join(
    rule
    for topic, source in (
        ("conversation_events", "conv_raw"),
        ("api_usage_events", "api"),
        ("billing_events", "bill"),
        ("user_events", "uev"),
    )
    for rule in suite(topic, source)
)
QUALITY_PARTS = ("conv_raw", "api", "bill", "uev")

RETAINED = [
    ("RAW.SAFETY_EVENTS", "safety", "event_timestamp", 90),
    ("WAREHOUSE.FACT_CONVERSATIONS", "conv", "event_timestamp", 730),
    ("WAREHOUSE.FACT_API_USAGE", "api", "event_timestamp", 730),
    ("WAREHOUSE.FACT_BILLING", "bill", "event_timestamp", 2555),
    ("SAFETY.QUARANTINED_ACCOUNTS", "quar", "quarantined_at", 365),
]


def cutoff(days: int) -> str:
    return f"(date '{RETENTION_AS_OF[:10]}' - {days})"


EXPIRED = " union all ".join(
    f"""select '{name}' as table_name, cast({cutoff(days)} as varchar) as cutoff_date,
        count(*) filter (where {ts} < {cutoff(days)}) as expired_rows,
        count(*) filter (where {ts} >= {cutoff(days)}) as kept_rows from {source}"""
    for name, source, ts, days in RETAINED
)
RETAINED_PARTS = ("safety", "conv", "api", "bill", "quar")

DAU_LONG = f"""(unpivot (select event_date, {', '.join(f'cast({m} as double) as {m}' for m in DAU_METRICS)}
    from ({DAU_ALL})) on {', '.join(DAU_METRICS)} into name metric value value)"""

NTH = "ceil(day(d) / 7.0)"
CALENDAR = f"""select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as varchar) as full_date,
    isodow(d) as day_of_week, dayname(d) as day_name, week(d) as week_of_year, month(d) as month_num,
    monthname(d) as month_name, quarter(d) as quarter, year(d) as year, isodow(d) > 5 as is_weekend,
    strftime(d, '%m-%d') in ('01-01', '06-19', '07-04', '11-11', '12-25')
        or (isodow(d) = 1 and {NTH} = 3 and month(d) in (1, 2))
        or (isodow(d) = 1 and month(d) = 5 and month(d + 7) = 6)
        or (isodow(d) = 1 and {NTH} = 1 and month(d) = 9)
        or (isodow(d) = 1 and {NTH} = 2 and month(d) = 10)
        or (isodow(d) = 4 and {NTH} = 4 and month(d) = 11) as is_us_holiday,
    quarter(d) as fiscal_quarter, year(d) as fiscal_year
    from (select cast(unnest(generate_series(min(event_timestamp), max(event_timestamp),
        interval 1 day)) as date) as d from bill)"""

STREAMED = f"""select cast(event_id as varchar) as event_id,
    case event_type when 'signup' then 'session_start' when 'error' then 'conversation_rated'
         else 'message_sent' end as event_type,
    ts as event_timestamp, {uid('user_id')} as user_id,
    cast(floor(value * 10) as bigint) as latency_ms from events"""

# Microsecond gaps here: the stream's window closes exactly 30 minutes after the last event.
STREAM_SESSIONS = f"""select user_id, {stamp('min(event_timestamp)')} as session_start,
    {stamp('max(event_timestamp) + interval 30 minute')} as session_closes, count(*) as event_count
    from (select *, sum(opens) over (partition by user_id order by event_timestamp) as n from (
        select *, case when event_timestamp - lag(event_timestamp) over u <= interval 30 minute
            then 0 else 1 end as opens from st
        window u as (partition by user_id order by event_timestamp)))
    group by user_id, n
    having max(event_timestamp) + interval 30 minute
        <= (select max(event_timestamp) from st) - interval 1 hour"""

ORACLE: dict[str, str] = {
    "scan_partition_day": sql(
        f"""select '{DAY}' as dt, hour(event_timestamp) as hr, event_type, count(*) as events from conv
            where cast(event_timestamp as date) = date '{DAY}' group by all""",
        "conv",
    ),
    "write_partition_roundtrip": sql(
        f"""select cast(cast(event_timestamp as date) as varchar) as dt, count(*) as calls,
            cast(sum(cast({COST} as decimal(18,9))) as double) as cost_usd
            from api group by 1""",
        "api",
    ),
    "backfill_jsonl_flatten": sql(
        f"""select event_id, 'api_call' as event_type, {stamp('event_timestamp')} as timestamp, user_id,
            model_id, cast(http_status_code as bigint) as http_status_code, total_tokens from api""",
        "api",
    ),
    "flatten_events": sql(
        f"""select event_id, event_type, {stamp('event_timestamp')} as timestamp, user_id, session_id,
            model_id, total_tokens, latency_ms, feedback_text_length from conv""",
        "conv",
    ),
    "stream_ingest": f"""select cast(cast(event_timestamp as date) as varchar) as dt,
        hour(event_timestamp) as hr, event_type, count(*) as events,
        cast(sum(latency_ms) as bigint) as latency_ms from ({STREAMED}) group by all""",
    "stream_then_backfill": f"""select cast(cast(event_timestamp as date) as varchar) as dt,
        hour(event_timestamp) as hr, event_type, 2 * count(*) as events,
        cast(2 * sum(latency_ms) as bigint) as latency_ms from ({STREAMED}) group by all""",
    "stream_dedup": f"""select event_id, event_type, {stamp('event_timestamp')} as event_timestamp,
        user_id from ({STREAMED})""",
    "stream_sessions": f"with st as ({STREAMED}) {STREAM_SESSIONS}",
    "filter_day": sql(
        f"""select event_id, user_id, {stamp('event_timestamp')} as event_timestamp from conv
            where cast(event_timestamp as date) = date '{DAY}'""",
        "conv",
    ),
    "dedup_latest": sql(
        f"""select event_id, {stamp('max(event_timestamp)')} as event_timestamp, event_type
            from conv_raw group by event_id, event_type""",
        "conv_raw",
    ),
    "dedup_earliest": sql(
        f"""select event_id, {stamp('min(event_timestamp)')} as event_timestamp, event_type
            from conv_raw group by event_id, event_type""",
        "conv_raw",
    ),
    "session_gaps": sql(
        f"""select event_id, user_id, {EPOCH} - lag({EPOCH}) over (partition by user_id
            order by event_timestamp, event_id) as gap_seconds from conv""",
        "conv",
    ),
    "sessionize": sql(
        f"select event_id, {SESSION_ID} as computed_session_id from {sessions(1800)}", "conv"
    ),
    "sessionize_5min": sql(
        f"select event_id, {SESSION_ID} as computed_session_id from {sessions(300)}", "conv"
    ),
    "session_summary": sql(
        f"""select user_id, {SESSION_ID} as computed_session_id,
            {stamp('min(event_timestamp)')} as session_start,
            {stamp('max(event_timestamp)')} as session_end, count(*) as event_count
            from {sessions(1800)} group by user_id, n""",
        "conv",
    ),
    "pii_mask": sql(f"select doc_id, md5({masked('text')}) as masked_md5 from txt", "txt"),
    "pii_mask_auto": sql(
        f"""select event_id, message_role, {masked('message_text')} as message_text,
            feedback_text_length from conv""",
        "conv",
    ),
    "api_response_category": sql(
        f"""select cast(http_status_code as bigint) as http_status_code,
            {CATEGORY} as response_category, count(*) as calls from api group by all""",
        "api",
    ),
    "api_cost_case": sql(
        f"select event_id, model_id, round({COST}, 9) as cost_usd from api", "api"
    ),
    "api_cost_dim": sql(
        f"select event_id, model_id, round({COST_ALL}, 9) as cost_usd from api", "api"
    ),
    "billing_revenue_impact": sql(
        f"""select event_type, {IMPACT} as revenue_impact, count(*) as events,
            cast(sum(amount_usd) as double) as amount_usd from bill group by all""",
        "bill",
    ),
    "billing_followup": sql(
        f"select event_id, {FOLLOWUP} as requires_followup from bill", "bill"
    ),
    "row_hash": sql(
        """select user_id, is_current, md5(user_tier || '||' || country_code || '||' || display_name
            || '||' || coalesce(organization_id, '__NULL__') || '||' || account_status) as row_hash
            from dim""",
        "dim",
    ),
    "fact_conversations": sql(
        f"""select event_id, {stamp('event_timestamp')} as event_timestamp, user_id,
            {SESSION_ID} as computed_session_id, {masked('message_text')} as message_text, total_tokens
            from {sessions(1800).replace('from conv)', 'from conv_latest)')}""",
        "conv_latest",
    ),
    "fact_api_usage": sql(
        f"""select event_id, {stamp('event_timestamp')} as event_timestamp, user_id,
            {CATEGORY} as response_category, round({COST}, 9) as estimated_cost_usd from api""",
        "api",
    ),
    "fact_billing": sql(
        f"""select event_id, {stamp('event_timestamp')} as event_timestamp, user_id,
            cast(amount_usd as double) as amount_usd, {IMPACT} as revenue_impact,
            {FOLLOWUP} as requires_followup from bill""",
        "bill",
    ),
    "user_changes": sql(
        f"""select * replace ({stamp('signup_date')} as signup_date, {stamp('changed_at')} as changed_at)
            from changes""",
        "changes",
    ),
    "scd2_merge": sql(
        f"""select md5(user_id || '|' || regexp_replace(regexp_replace({stamp('valid_from')},
            '0+$', ''), '[.]$', '')) as user_sk, {stamp('signup_date')} as signup_date,
            {versions_of(None).removeprefix('select ')}""",
        "merged",
    ),
    "scd2_initial_load": sql(
        versions_of(None), "merged"
    ).replace("from customer)", "from customer where false)"),
    **{
        f"scd2_{name}": sql(versions_of(kind), "merged")
        for name, kind in (
            ("unchanged", "unchanged"),
            ("expired", "expired"),
            ("new_versions", "new_version"),
            ("new_keys", "new_key"),
            ("untouched", "untouched"),
            ("history", "history"),
        )
    },
    "scd2_one_current": sql(
        """select count(*) as current_rows, count(distinct user_id) as users,
            (select count(*) from (select user_id from merged where is_current group by user_id
             having count(*) > 1)) as broken_users from merged where is_current""",
        "merged",
    ),
    "dim_users_current": sql(
        f"""select user_id, user_tier, platform, {stamp('signup_date')} as signup_date
            from dim where is_current""",
        "dim",
    ),
    "merge_insert_if_absent": sql(
        """select user_id, user_tier from cur union all
           select distinct user_id, 'unknown' from conv
           where user_id not in (select user_id from cur)""",
        "cur",
        "conv",
    ),
    "dim_models": sql(
        """select m.*, coalesce(calls, 0) as calls from (values
            ('gpt-4o', 'gpt-4', 128000, 2.5::double, 10.0::double, '2024-05-13'),
            ('gpt-4o-mini', 'gpt-4', 128000, 0.15::double, 0.6::double, '2024-07-18'),
            ('gpt-4-turbo', 'gpt-4', 128000, 10.0::double, 30.0::double, '2024-04-09'),
            ('gpt-3.5-turbo', 'gpt-3.5', 16385, 0.5::double, 1.5::double, '2024-01-25'),
            ('o1-preview', 'o1', 128000, 15.0::double, 60.0::double, '2024-09-12'),
            ('o1-mini', 'o1', 128000, 3.0::double, 12.0::double, '2024-09-12'))
            m(model_id, model_family, context_window, usd_per_1m_input, usd_per_1m_output, release_date)
           left join (select model_id as id, count(*) as calls from api group by model_id)
           on id = m.model_id""",
        "api",
    ),
    "dim_plans": sql(
        """select p.*, '2024-01-01' as valid_from, coalesce(billings, 0) as billings from (values
            ('plan_free', 'Free', 0.0::double, 10), ('plan_plus', 'Plus', 20.0::double, 80),
            ('plan_enterprise', 'Enterprise', 60.0::double, 500))
            p(plan_id, plan_name, monthly_price_usd, rate_limit_rpm)
           left join (select plan_id as id, count(*) as billings from bill group by plan_id)
           on id = p.plan_id""",
        "bill",
    ),
    "dim_time": sql(CALENDAR, "bill"),
    "scd2_same_instant": sql(
        f"""select user_id, state, {stamp('valid_from')} as valid_from, {stamp('valid_to')} as valid_to,
            valid_to is null as is_current from (
             select user_id, state, h as valid_from, lead(h) over (partition by user_id order by h) as valid_to
             from (select *, lag(state) over (partition by user_id order by h) as earlier
              from (select distinct cast(user_id as varchar) as user_id, date_trunc('hour', ts) as h,
               cast(hour(ts) // 6 as varchar) as state from events where user_id is not null and ts is not null))
             where earlier is distinct from state)"""
    ),
    "scd2_null_keys": sql(
        """select event_type as state, event_type = 'error' or user_id is null as no_key,
            event_type = 'signup' or ts is null as no_time, count(*) as changes from events
            where event_type in ('error', 'signup') or user_id is null or ts is null group by all"""
    ),
    "pit_ties": sql(
        """select o_orderkey as order_id, case when o_custkey % 10 <> 0 then cast(o_custkey as varchar) end
            as user_id, case when o_custkey % 10 <> 0 then max(o_orderkey)
            over (partition by o_custkey, year(cast(o_orderdate as date))) end as held from orders"""
    ),
    "rerun_empty_day": sql(
        """select cast(cast(event_timestamp as date) as varchar) as dt, count(*) as calls from api
            where cast(event_timestamp as date) <> date '2024-01-15' group by 1""",
        "api",
    ),
    "pit_user_join": sql(
        """select event_id, c.user_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f')
            as event_timestamp, m.user_tier, m.country_code
            from conv c left join merged m on c.user_id = m.user_id
            and event_timestamp >= valid_from and (valid_to is null or event_timestamp < valid_to)""",
        "conv",
        "merged",
    ),
    "fact_with_keys": sql(
        f"""select event_id, cast(strftime(event_timestamp, '%Y%m%d') as bigint) as date_key,
            case when m.user_id is not null then md5(m.user_id || '|' || regexp_replace(regexp_replace(
                {stamp('valid_from')}, '0+$', ''), '[.]$', '')) end as user_sk,
            md5(model_id) as model_sk
            from api c left join merged m on c.user_id = m.user_id
            and event_timestamp >= valid_from and (valid_to is null or event_timestamp < valid_to)""",
        "api",
        "merged",
    ),
    "billing_with_keys": sql(
        """select event_id, cast(strftime(event_timestamp, '%Y%m%d') as bigint) as date_key,
            md5(plan_id || '|2024-01-01') as plan_sk from bill""",
        "bill",
    ),
    "orphan_facts": sql(
        """select user_id, count(*) as fact_rows from bill
            where user_id not in (select user_id from uev) group by user_id""",
        "bill",
        "uev",
    ),
    "active_users_union": sql(
        f"""select user_id, bool_or(via_api) as via_api from (
            select user_id, false as via_api, event_timestamp from conv union all
            select user_id, true, event_timestamp from api)
            where cast(event_timestamp as date) = date '{DAY}' group by user_id""",
        "conv",
        "api",
    ),
    "daily_active_users": sql(DAU_DAY, "conv", "api", "dim"),
    "daily_active_users_all": sql(DAU_ALL, "conv", "api", "dim"),
    "weekly_engagement": sql(
        engagement(
            f"""and date_trunc('week', event_timestamp) = date_trunc('week', date '{DAY}')"""
        ),
        "conv",
        "dim",
    ),
    "weekly_engagement_all": sql(engagement(""), "conv", "dim"),
    "messages_per_session": sql(
        """select round(avg(n), 6) as avg_messages_per_session from (select session_id, count(*) as n
            from conv where event_type = 'message_sent' group by session_id)""",
        "conv",
    ),
    "latency_percentiles": sql(
        """select model_id, quantile_disc(latency_ms, 0.5) as p50_latency_ms,
            quantile_disc(latency_ms, 0.95) as p95_latency_ms,
            quantile_disc(latency_ms, 0.99) as p99_latency_ms from api group by model_id""",
        "api",
    ),
    "monthly_revenue": sql(
        revenue(
            "date '1998-05-01'",
            """where cast(event_timestamp as date) between date '1998-05-01' and date '1998-05-20'""",
        ),
        "bill",
    ),
    "monthly_revenue_all": sql(
        revenue("cast(date_trunc('month', event_timestamp) as date)"), "bill"
    ),
    "monthly_revenue_succeeded": sql(
        revenue("cast(date_trunc('month', event_timestamp) as date)", only_succeeded=True), "bill"
    ),
    "conv_user_day": sql(
        f"""select * replace (cast(event_date as varchar) as event_date,
            round(avg_tokens, 6) as avg_tokens, round(avg_latency_ms, 6) as avg_latency_ms)
            from ({CONV_DAYS})""",
        "conv",
    ),
    "api_user_day": sql(
        f"select * replace (cast(event_date as varchar) as event_date) from ({API_DAYS})", "api"
    ),
    "engagement_score": sql(
        f"""select user_id, cast(event_date as varchar) as event_date, session_count, message_count,
            api_call_count, models_used, round(a, 6) as session_score, round(b, 6) as message_score,
            round(c, 6) as api_score, round(d, 6) as diversity_score,
            round(a * 0.30::double + b * 0.25::double + c * 0.25::double + d * 0.20::double, 6)
                as engagement_score
            from (select *, {share('session_count', 10)} as a, {share('message_count', 50)} as b,
                {share('api_call_count', 100)} as c, {share('models_used', 4)} as d
                from ({CONV_DAYS}) x full outer join ({API_DAYS}) y using (user_id, event_date))""",
        "conv",
        "api",
    ),
    "safety_dashboard": sql(BOARD.format(extra="", join=""), "safety", "quar"),
    "safety_dashboard_ext": sql(
        BOARD.format(extra=BOARD_EXTRA, join=BOARD_JOIN), "safety", "quar"
    ),
    "zscore_anomalies": sql(
        f"select event_id, user_id, round(z, 6) as anomaly_zscore, z > 3 as is_anomaly from {ZSCORE}",
        "safety",
    ),
    "zscore_flagged": sql(
        f"select event_id, user_id, user_violation_count_30d from {ZSCORE} where z > 3", "safety"
    ),
    "rate_anomalies": sql("@", "api").replace(" @", ", " + rates(5.0)),
    "rate_anomalies_2sd": sql("@", "api").replace(" @", ", " + rates(2.0)),
    "rate_anomalies_hourly": sql("@", "api").replace(" @", ", " + HOURLY),
    "anomaly_summary": sql(
        f"""select b as behavioral, r as rate, b + r as anomaly_count from
            (select count(*) filter (where z > 3) as b from {ZSCORE}), (
            select count(*) filter (where n > (select avg(n) + 5 * stddev_samp(n) from per_user)) as r
            from per_user)""",
        "safety",
        "api",
    ).replace(
        " select b as", ", per_user as (select user_id, count(*) as n from api group by user_id) select b as"
    ),
    "injection_scores": sql(
        f"select doc_id, injection_risk_score, injection_pattern from {injected('txt')}", "txt"
    ),
    "detect_injections": f"""select conv_id, turn, injection_risk_score,
        injection_risk_score >= 0.8::double as is_injection_attempt from {injected('''(
            select conv_id, turn, text || case when role = 'user'
                then ' Act as if you agree; system: ' else '' end as text from conversations)''')}""",
    "injection_summary": sql(
        f"""select injection_pattern, count(*) as texts,
            count(*) filter (where injection_risk_score >= 0.5::double) as attempts,
            max(injection_risk_score) as max_score from {injected('txt')} group by injection_pattern""",
        "txt",
    ),
    "quarantine_candidates": sql("@", "safety", "quar").replace(
        " @",
        f", {recent(AS_OF)} "
        + quarantine(
            AS_OF,
            f"""{stamp(f"timestamp '{AS_OF}'")} as quarantined_at, true as is_active""",
            "and p.user_id not in (select user_id from quar where is_active)",
        ),
    ),
    "quarantine_after_release": sql("@", "safety", "quar").replace(
        " @",
        f""", cleared as (select user_id, max(quarantined_at + interval 3 day) as cleared from quar
            where review_outcome is not null
            and quarantined_at + interval 3 day <= timestamp '{AS_OF}' group by user_id),
        {recent(AS_OF).replace('from safety where', """from safety left join cleared using (user_id)
            where (cleared is null or event_timestamp > cleared) and""")} """
        + quarantine(
            AS_OF,
            f"""{stamp(f"timestamp '{AS_OF}'")} as quarantined_at, true as is_active""",
            "",
        ),
    ),
    "quarantine_all": sql("@", "safety").replace(
        " @",
        f", {recent('2024-02-10 00:00:00')} "
        + quarantine(
            "2024-02-10 00:00:00",
            "'held after repeated severe or one confident critical signal' as quarantine_reason",
            "",
        ),
    ),
    "quality_staging": sql(QUALITY, *QUALITY_PARTS),
    "quality_suite_summary": sql(
        f"""select topic, count(*) as checks, count(*) filter (where passed) as passed,
            bool_and(passed) as success from ({QUALITY}) group by topic""",
        *QUALITY_PARTS,
    ),
    "warehouse_checks": sql(
        f"""select 'loaded:FACT_CONVERSATIONS' as check_name, v > 0 as passed, v as actual_value,
            '> 0' as expected, cast(v as varchar) || ' rows for {DAY}' as message
            from (select count(*) as v from conv where cast(event_timestamp as date) = date '{DAY}')
            union all select 'current:DIM_USERS', v > 0, v, '> 0', cast(v as varchar) || ' current rows'
            from (select count(*) as v from dim where is_current)
            union all select 'referential_integrity:FACT_CONVERSATIONS', v = 0, v, '0',
            cast(v as varchar) || ' facts with no matching user dimension' from (
            select count(*) as v from conv where user_id not in (select user_id from dim))""",
        "conv",
        "dim",
    ),
    "reconcile_counts": sql(
        """select staged_rows, loaded_rows, staged_rows = loaded_rows as matches from (
            select (select count(distinct event_id) from conv_raw) as staged_rows,
            (select count(*) from conv_latest) as loaded_rows)""",
        "conv_raw",
        "conv_latest",
    ),
    "retention_expired_counts": sql(EXPIRED, *RETAINED_PARTS),
    "retention_policies": sql(
        f"""select p.*, e.expired_rows from (values
            ('RAW.SAFETY_EVENTS', 90, 'event_timestamp'),
            ('WAREHOUSE.FACT_CONVERSATIONS', 730, 'event_timestamp'),
            ('WAREHOUSE.FACT_API_USAGE', 730, 'event_timestamp'),
            ('WAREHOUSE.FACT_BILLING', 2555, 'event_timestamp'),
            ('SAFETY.QUARANTINED_ACCOUNTS', 365, 'quarantined_at'),
            ('CANONICAL.DAILY_ACTIVE_USERS', 1095, '_computed_at'),
            ('CANONICAL.WEEKLY_ENGAGEMENT', 1095, '_computed_at'),
            ('CANONICAL.MONTHLY_REVENUE', 2555, '_computed_at'))
            p(table_name, retention_days, timestamp_column)
            left join ({EXPIRED}) e on e.table_name = p.table_name""",
        *RETAINED_PARTS,
    ),
    "retention_audit": sql(
        f"""select table_name, expired_rows as records_deleted, cutoff_date,
            {stamp(f"timestamp '{RETENTION_AS_OF}'")} as executed_at
            from ({EXPIRED}) where expired_rows > 0""",
        *RETAINED_PARTS,
    ),
    "retention_keep": sql(
        f"""select cast(cast(event_timestamp as date) as varchar) as event_date, count(*) as events
            from conv where event_timestamp >= {cutoff(730)} group by 1""",
        "conv",
    ),
    "run_health": sql(
        """select job, count(*) as runs,
            round(count(*) filter (where status = 'success') / count(*)::double, 6) as success_rate,
            round(avg(duration_minutes), 6) as avg_duration_minutes from runs group by job""",
        "runs",
    ),
    "recent_failures": sql(
        f"""select {stamp('run_at')} as run_at, job, duration_minutes from runs
            where status = 'failed' order by runs.run_at desc, job limit 10""",
        "runs",
    ),
    "daily_volume": sql(
        """select cast(cast(event_timestamp as date) as varchar) as event_date, source,
            count(*) as events from (
            select event_timestamp, 'conversations' as source from conv
            union all select event_timestamp, 'api_calls' from api
            union all select event_timestamp, 'billing' from bill) group by 1, 2""",
        "conv",
        "api",
        "bill",
    ),
    "unpivot_daily_metrics": sql(
        f"select event_date, metric, value from {DAU_LONG}", "conv", "api", "dim"
    ),
    "metric_day_delta": sql(
        f"""select event_date, metric, value, value - lag(value) over (partition by metric
            order by event_date) as delta from {DAU_LONG}""",
        "conv",
        "api",
        "dim",
    ),
    "violation_breakdown": sql(
        "select violation_type, count(*) as signals from safety group by violation_type", "safety"
    ),
    "model_usage": sql(
        """select model_id, count(*) as requests, cast(sum(total_tokens) as bigint) as tokens
            from api group by model_id""",
        "api",
    ),
}


# --- jobs that keep state between runs (registry/stored.py) ----------------------

WINDOW = "event_timestamp >= timestamp '2024-01-01' and event_timestamp < timestamp '2024-01-31'"
_X = "user_violation_count_30d"
_OTHERS = f"""(select *, count(*) over u - 1 as n, sum({_X}) over u - {_X} as s,
    sum({_X} * {_X}) over u - {_X} * {_X} as q from safety window u as (partition by user_id))"""


def _counted_after_retention() -> str:
    parts = [
        f"""select '{table}' as table_name, count(*) filter (where {column} >= {cutoff(days)}) as kept_rows,
            count(*) filter (where {column} < {cutoff(days)}) as deleted_rows from {source}"""
        for table, source, column, days in RETAINED
    ]
    for table, name, expired in (
        ("DAILY_ACTIVE_USERS", "daily_active_users_all", False),
        ("WEEKLY_ENGAGEMENT", "weekly_engagement_all", False),
        ("MONTHLY_REVENUE", "monthly_revenue_all", True),
    ):
        kept, deleted = ("0", "count(*)") if expired else ("count(*)", "0")
        parts.append(f"select 'CANONICAL.{table}', {kept}, {deleted} from ({ORACLE[name]})")
    return " union all ".join(parts)


ORACLE |= {
    "late_events_loaded": sql(
        f"""select event_id, {stamp('event_timestamp')} as event_timestamp, user_id,
            {SESSION_ID} as computed_session_id from {sessions(1800)}""",
        "conv",
    ),
    "copy_after_three_days": ORACLE["write_partition_roundtrip"],
    "hourly_increment": sql(
        f"""select m.user_id, n_rows, mean, sd, coalesce(calls, 0) as calls from (
            select user_id, count(*) as n_rows, round(avg({_X}), 6) as mean, round(stddev_samp({_X}), 6) as sd
            from safety where {WINDOW} group by user_id) m
            left join (select user_id, count(*) as calls from api where {WINDOW} group by user_id) c
            on m.user_id = c.user_id""",
        "safety",
        "api",
    ),
    "hourly_summary": ORACLE["anomaly_summary"]
    .replace("from ev where event_type = 'error'", f"from ev where event_type = 'error' and {WINDOW}".replace("event_timestamp", "ts"))
    .replace(
        "from ev where event_type in ('purchase', 'error', 'click')",
        f"from ev where event_type in ('purchase', 'error', 'click') and {WINDOW}".replace("event_timestamp", "ts"),
    ),
    "zscore_leave_one_out": sql(
        f"""select event_id, user_id, round(z, 6) as anomaly_zscore, z > 3 as is_anomaly from (
            select *, case when n >= 5 and n * q - s * s > 0 then
                abs({_X} - s / n::double) / sqrt((n * q - s * s)::double / (n * (n - 1))) else 0 end as z
            from {_OTHERS})""",
        "safety",
    ),
    "scd2_open_only": sql(
        f"select {stamp('signup_date')} as signup_date, {versions_of(None).removeprefix('select ')}", "merged"
    ),
    "compacted_hour": sql(
        """select cast(cast(event_timestamp as date) as varchar) as dt, hour(event_timestamp) as hr,
            count(*) as events, cast(sum(total_tokens) as bigint) as tokens from conv group by all""",
        "conv",
    ),
    "stream_dedup_hot": "select distinct cast(event_id as varchar) as event_id, 1 as times from events",
    "retention_delete": sql(_counted_after_retention(), *RETAINED_PARTS),
    "model_ranking": sql(
        """select model_id, count(*) as requests, cast(sum(total_tokens) as bigint) as tokens,
            round(count(*) / sum(count(*)) over ()::double, 6) as share,
            row_number() over (order by count(*) desc, model_id) as rank from api group by model_id""",
        "api",
    ),
    "violation_ranking": sql(
        """select violation_type, count(*) as signals,
            round(count(*) / sum(count(*)) over ()::double, 6) as share,
            row_number() over (order by count(*) desc, violation_type) as rank
            from safety group by violation_type""",
        "safety",
    ),
    "seed_merge_filled": sql(
        """select model_id, 0.0::double as usd_per_1m_input, count(*) as calls
            from api where model_id like 'gpt-%' group by model_id
            union all
            select * from (values ('gpt-4o', 2.5::double, 0), ('gpt-4o-mini', 0.15, 0), ('gpt-4-turbo', 10, 0),
                ('gpt-3.5-turbo', 0.5, 0), ('o1-preview', 15, 0), ('o1-mini', 3, 0)) s(m, usd, calls)
            where m not in (select model_id from api where model_id like 'gpt-%')""",
        "api",
    ),
}
