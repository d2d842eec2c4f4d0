"""Independent DuckDB SQL for every registered query (the correctness gate).

The SQL runs on the raw test tables (view ``events``) and re-derives the event
log with the same mapping as the Spark adapter, then computes each metric the
plain relational way: global windows, ``count(DISTINCT ...)`` and explicit
rank-based quantiles.  Label formatting is written out with DuckDB's own
functions (``round_even``, ``printf``, ``format``).
"""

from __future__ import annotations


class C:
    """Fixed values of the test data's programme, written out here so that the
    oracle does not share them with the code it checks."""

    CASEWORKER_INVITED = 'CaseworkerInvitedApplicantToFlow'
    VIEWED_AGREEMENT = 'ApplicantViewedAgreement'
    SHARED_INCOME_SUMMARY = 'ApplicantSharedIncomeSummary'
    SEARCHED_EMPLOYER = 'ApplicantSearchedForEmployer'
    MISSING_RESULTS = 'ApplicantAccessedMissingResultsPage'
    SELECTED_EMPLOYER = 'ApplicantSelectedEmployerOrPlatformItem'
    FINISHED_SYNC = 'ApplicantFinishedSync'
    CLICKED_INVITATION = 'ApplicantClickedCBVInvitationLink'
    CLICKED_GENERIC = 'ApplicantClickedGenericLink'
    BAN_LOOKUP = (('ApplicantViewedAgreement', 'n_started'),
         ('ApplicantSharedIncomeSummary', 'n_completed'),
         ('ApplicantSearchedForEmployer', 'n_searches'),
         ('ApplicantAccessedMissingResultsPage', 'n_searches_missing'))
    TREND_LOOKUP = (('CaseworkerInvitedApplicantToFlow', 'Invitations Sent to Applicants'),
         ('ApplicantViewedAgreement', 'Sessions Started'),
         ('ApplicantSharedIncomeSummary', 'Sessions Completed'))
    WEEKLY_LOOKUP = (('ApplicantClickedCBVInvitationLink', 'initiation_token'),
         ('ApplicantClickedGenericLink', 'initiation_generic'),
         ('ApplicantRestartedWithGenericLinkOnTimeout', 'initiation_generic_restart'),
         ('ApplicantViewedAgreement', 'started'),
         ('ApplicantSharedIncomeSummary', 'completed'),
         ('ApplicantAttemptedLogin', 'login_attempt'),
         ('ApplicantSucceededWithLogin', 'login_success'),
         ('ApplicantOpenedHelpModal', 'help'),
         ('ApplicantViewedHelpTopic', 'help'),
         ('ApplicantSearchedForEmployer', 'search'),
         ('ApplicantAccessedMissingResultsPage', 'search_missing'),
         ('ApplicantEncounteredError', 'error'),
         ('CaseworkerInvitedApplicantToFlow', 'invitation'),
         ('ApplicantFinishedSync', 'synced'),
         ('ApplicantCopiedInvitationLink', 'copied_invite'))
    SEARCH_IGNORED_EVENTS = ('ApplicantViewedHelpText', 'ApplicantOpenedHelpModal', 'ApplicantViewedHelpTopic')
    SEARCH_TIE_PRIORITY = ('ApplicantSelectedEmployerOrPlatformItem', 'ApplicantBeganLinkingEmployer')
    SEARCH_STOP_WORDS = ('inc', 'llc', 'ltd', 'co', 'corp', 'the')
    DEVICE_KEEP = ('desktop', 'smartphone', 'unknown')
    DEVICE_ORDER = ('desktop', 'other', 'unknown', 'smartphone')
    EVENT_DICTIONARY = (('ApplicantClickedCBVInvitationLink', 'Clicked Invitation Link'),
         ('ApplicantClickedGenericLink', 'Clicked Generic Link'),
         ('ApplicantRestartedWithGenericLinkOnTimeout', 'Restarted After Timeout'),
         ('ApplicantViewedAgreement', 'Agreed'),
         ('ApplicantSearchedForEmployer', 'Searched Employer'),
         ('ApplicantAccessedMissingResultsPage', 'Missing Results'),
         ('ApplicantSelectedEmployerOrPlatformItem', 'Selected Employer'),
         ('ApplicantBeganLinkingEmployer', 'Began Linking'),
         ('ApplicantAttemptedLogin', 'Attempted Login'),
         ('ApplicantSucceededWithLogin', 'Logged In'),
         ('ApplicantFinishedSync', 'Finished Sync'),
         ('ApplicantSharedIncomeSummary', 'Shared Income Summary'),
         ('ApplicantOpenedHelpModal', 'Opened Help'),
         ('ApplicantViewedHelpTopic', 'Viewed Help Topic'),
         ('ApplicantViewedHelpText', 'Viewed Help Text'),
         ('ApplicantEncounteredError', 'Encountered Error'),
         ('ApplicantCopiedInvitationLink', 'Copied Invitation Link'),
         ('CaseworkerInvitedApplicantToFlow', 'Invited Applicant'))
    KEY_EVENTS = ('ApplicantViewedAgreement',
         'ApplicantSearchedForEmployer',
         'ApplicantSelectedEmployerOrPlatformItem',
         'ApplicantBeganLinkingEmployer',
         'ApplicantAttemptedLogin',
         'ApplicantSucceededWithLogin',
         'ApplicantFinishedSync',
         'ApplicantSharedIncomeSummary')
    STEP_RENAMES = (('Agreed', 'Consented'),)
    ADDTL_NAMES = (('n_sessions', 'Number of Sessions'),
         ('n_applicants', 'Distinct Applicants'),
         ('n_completed', 'Number of Completed Sessions'),
         ('duration_complete', 'Time to Complete (Median, Min.)'),
         ('duration_sync', 'Payroll Provider Sync Time (Median, Sec.)'),
         ('share_smartphone', 'Share Smartphones (Sessions)'),
         ('share_gig', 'Share Gig (Sessions of Completed)'))
    BAN_LABELS = (('n_started', 'Verifications\nStarted'),
         ('share_completed', 'Completion\nRate'),
         ('duration_complete', 'Time to\nComplete'),
         ('share_missing_searches', 'Missing\nSearch Results'))
    DASHBOARD_CARDS = (('applicants', 'n_started', 'Income Verification Started'),
         ('applicants', 'share_complete', 'Completion Rate'),
         ('events', 'share_tokenized', 'Tokenized Link Share'),
         ('applicants', 'share_login_success', 'Successful Account Logins'),
         ('applicants', 'n_multi_employers', 'Multi Employer Submissions'),
         ('events', 'share_search_missing', 'Missing Search Results'),
         ('events', 'n_copied_invite', 'Copied Invitation Link'))
    NOT_CAPTURED = '[not captured]'
    NO_PRIOR = 'No prior period'
    NO_CHANGE = 'No change'
    PILOTS = (("Testland", "tst", "Pilot A", "2024-01-01", "2024-01-14"),
              ("Testland", "tst", "Pilot B", "2024-01-16", "2024-01-29"))
    MASK_SEED, MASK_SHARE, MASK_DAYS, MASK_YEARS, MASK_STATE = "42", 0.6, 180, 24, "North Grouchland"
    SIGNUP_EVENTS = ((20, 'ClickedCBVInvitationLink'),
         (35, 'ClickedGenericLink'),
         (40, 'RestartedWithGenericLinkOnTimeout'),
         (50, None),
         (None, 'ViewedAgreement'))
    VIEW_EVENTS = ((60, 'SearchedForEmployer'),
         (75, 'AccessedMissingResultsPage'),
         (None, 'SelectedEmployerOrPlatformItem'))
    CLICK_EVENTS = ((30, 'AttemptedLogin'),
         (50, 'SucceededWithLogin'),
         (60, 'OpenedHelpModal'),
         (70, 'ViewedHelpTopic'),
         (75, 'ViewedHelpText'),
         (85, 'BeganLinkingEmployer'),
         (None, 'CopiedInvitationLink'))
    PURCHASE_EVENTS = ((50, 'FinishedSync'), (None, 'SharedIncomeSummary'))
    SEARCH_TEXTS = ('  The  Red-Plate, Inc. ', 'red plate', 'Hot Ring LLC', 'hot   ring', 'Wal-Mart', 'The Co')


# --------------------------------------------------------------------------- helpers


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _case(col: str, pairs) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in pairs) + " END"


def pct(x: str) -> str:
    return f"(CAST(CAST(round_even(({x}) * 100.0::DOUBLE, 0) AS BIGINT) AS VARCHAR) || '%')"


def comma(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN format('{{:,}}', CAST(round_even(({x})::DOUBLE, 0) AS BIGINT)) END)"


def number(x: str, digits: int = 1, suffix: str = "") -> str:
    if digits <= 0:
        body = f"CAST(CAST(round_even(({x})::DOUBLE, 0) AS BIGINT) AS VARCHAR)"
    else:
        body = f"printf('%.{digits}f', round_even(({x})::DOUBLE, {digits}) + 0.0::DOUBLE)"
    return f"({body} || {_q(suffix)})"


def short_scale(x: str, digits: int = 1, unscaled_digits: int | None = None) -> str:
    ud = digits if unscaled_digits is None else unscaled_digits
    v = f"(({x})::DOUBLE)"
    parts = [f"WHEN abs({v}) >= {b!r}::DOUBLE THEN {number(f'{v} / {b!r}::DOUBLE', digits, s)}"
             for b, s in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K"))]
    return f"(CASE {' '.join(parts)} ELSE {number(v, ud)} END)"


def timespan(x: str, unit: str = "secs", digits: int = 0) -> str:
    factor = {"secs": 1.0, "mins": 60.0}[unit]
    s = f"(({x})::DOUBLE * {factor!r}::DOUBLE)"
    units = ((604800.0, "w"), (86400.0, "d"), (3600.0, "h"), (60.0, "m"), (1.0, "s"), (1e-3, "ms"), (1e-6, "us"))
    parts = [f"WHEN {s} = 0 THEN {number(s, digits, 's')}"]
    parts += [f"WHEN abs({s}) >= {b!r}::DOUBLE THEN {number(f'{s} / {b!r}::DOUBLE', digits, u)}" for b, u in units]
    return f"(CASE {' '.join(parts)} ELSE {number(f'{s} / 1e-09::DOUBLE', digits, 'ns')} END)"


def ratio(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def squish(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"


def normalize(x: str) -> str:
    words = "|".join(C.SEARCH_STOP_WORDS)
    s = squish(f"lower({x})")
    s = f"regexp_replace({s}, '[^a-z0-9 ]', '', 'g')"
    s = f"regexp_replace({s}, '\\b({words})\\b', '', 'g')"
    return squish(s)


def quantile_select(src: str, keys: list[str], value: str, probs: dict[str, float], stats: bool = True) -> str:
    """Type-7 quantiles from explicit order statistics: lo + (hi-lo)*frac."""
    kc = ", ".join(keys)
    part = f"PARTITION BY {kc}" if keys else ""
    inner = (f"SELECT {kc + ', ' if keys else ''}{value} AS v, row_number() OVER ({part} ORDER BY {value}) AS rn, "
             f"count(*) OVER ({part}) AS n FROM {src} WHERE {value} IS NOT NULL AND NOT isnan({value})")
    picks = []
    outs = []
    for name, p in probs.items():
        h = f"((n - 1)::DOUBLE * {float(p)!r}::DOUBLE)"
        picks.append(f"max(CASE WHEN rn = floor({h}) + 1 THEN v END) AS {name}_lo")
        picks.append(f"max(CASE WHEN rn = ceil({h}) + 1 THEN v END) AS {name}_hi")
        picks.append(f"any_value({h}) AS {name}_h")
        outs.append(f"{name}_lo + ({name}_hi - {name}_lo) * ({name}_h - floor({name}_h)) AS {name}")
    st = ["CAST(n AS BIGINT) AS n", "mn AS min", "mx AS max"] if stats else []
    grp = f"{kc}, n" if keys else "n"
    return (f"SELECT {kc + ', ' if keys else ''}{', '.join(st + outs)} FROM ("
            f"SELECT {kc + ', ' if keys else ''}n, min(v) AS mn, max(v) AS mx, {', '.join(picks)} "
            f"FROM ({inner}) GROUP BY {grp})")


# --------------------------------------------------------------------------- shared CTEs


def _event_case() -> str:
    def ladder(steps):
        out = []
        for bound, name in steps:
            label = C.CASEWORKER_INVITED if name is None else "Applicant" + name
            out.append(f"ELSE {_q(label)}" if bound is None else f"WHEN k < {bound} THEN {_q(label)}")
        return "CASE " + " ".join(out) + " END"

    return ("CASE event_type "
            f"WHEN 'signup' THEN {ladder(C.SIGNUP_EVENTS)} "
            f"WHEN 'view' THEN {ladder(C.VIEW_EVENTS)} "
            f"WHEN 'click' THEN {ladder(C.CLICK_EVENTS)} "
            f"WHEN 'purchase' THEN {ladder(C.PURCHASE_EVENTS)} "
            "WHEN 'error' THEN 'ApplicantEncounteredError' END")


def _pilot_values() -> str:
    rows = ", ".join(f"({_q(state)}, {_q(agency)}, {_q(pilot)}, DATE '{start}', DATE '{end}')"
                     for state, agency, pilot, start, end in C.PILOTS)
    return f"pilots(state, client_agency, pilot, start_date, end_date) AS (VALUES {rows})"


def _masked_plog_ctes() -> str:
    """The masked demo event set under the name ``plog`` (original: ``plog0``),
    and its pilot calendar (start = first masked date of each pilot)."""
    return f"""
m_ids AS (SELECT DISTINCT distinct_id FROM plog0 WHERE distinct_id IS NOT NULL),
m_rk AS (SELECT distinct_id, row_number() OVER (ORDER BY md5(distinct_id || {_q(C.MASK_SEED)}), distinct_id) AS rn,
           count(*) OVER () AS n FROM m_ids),
m_chosen AS (SELECT distinct_id FROM m_rk WHERE rn <= floor(n::DOUBLE * {C.MASK_SHARE!r}::DOUBLE)),
m_both AS (SELECT * FROM plog0 UNION ALL
           SELECT * REPLACE (distinct_id || '-c' AS distinct_id, cbv_flow_id + 1000000 AS cbv_flow_id) FROM plog0
           WHERE distinct_id IN (SELECT distinct_id FROM m_chosen)),
m_sh AS (SELECT * REPLACE (ts + INTERVAL {C.MASK_DAYS} DAY + INTERVAL {C.MASK_YEARS} YEAR AS ts) FROM m_both),
m_fd AS (SELECT pilot, strftime(min(CAST(ts AS DATE)), '%b %Y') AS label FROM m_sh WHERE pilot IS NOT NULL
         GROUP BY pilot),
plog AS (SELECT m_sh.* REPLACE (m_fd.label AS pilot, {_q(C.MASK_STATE)} AS pilot_state)
         FROM m_sh LEFT JOIN m_fd ON m_sh.pilot = m_fd.pilot),
m_cal AS (SELECT {_q(C.MASK_STATE)} AS state, pilot, min(CAST(ts AS DATE)) AS start_date FROM plog
          WHERE pilot IS NOT NULL GROUP BY pilot)"""


def base_ctes(masked: bool = False) -> str:
    texts = "[" + ", ".join(_q(t) for t in C.SEARCH_TEXTS) + "]"
    plog_name = "plog0" if masked else "plog"
    masked_ctes = ("," + _masked_plog_ctes()) if masked else ""
    cal_src = "m_cal" if masked else "pilots"
    return f"""
ev0 AS (
  SELECT event_id, ts, user_id, value, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev1 AS (SELECT *, {_event_case()} AS event FROM ev0),
log AS (
  SELECT event_id, event, ts,
    CASE WHEN k <> 99 THEN CAST(user_id AS VARCHAR) END AS distinct_id,
    CASE WHEN k <> 99 AND event <> {_q(C.CASEWORKER_INVITED)}
         THEN CAST(user_id * 100 + floor((dayofmonth(ts) - 1) / 7.0::DOUBLE) AS BIGINT) END AS cbv_flow_id,
    'Testland' AS pilot_state,
    CASE k % 4 WHEN 1 THEN 'smartphone' WHEN 2 THEN 'desktop' WHEN 3 THEN 'tablet' END AS device_type,
    CASE k % 3 WHEN 1 THEN 'sms' WHEN 2 THEN 'email' END AS origin,
    CASE WHEN k % 5 = 0 THEN 'gig' WHEN k % 5 < 4 THEN 'w2' END AS employment_type,
    CASE WHEN event = {_q(C.FINISHED_SYNC)} AND k % 4 <> 0 THEN 'Employer ' || CAST(k % 7 AS VARCHAR) END
      AS employer_name,
    CASE WHEN event = {_q(C.SEARCHED_EMPLOYER)} THEN {texts}[k % 6 + 1] END AS query,
    CASE WHEN event = {_q(C.FINISHED_SYNC)} THEN value END AS sync_duration_seconds,
    CASE WHEN event = {_q(C.SHARED_INCOME_SUMMARY)} THEN (value * 60) / 60.0::DOUBLE END
      AS flow_started_minutes_ago
  FROM ev1),
{_pilot_values()},
days AS (SELECT state, CAST(day AS DATE) AS day, arg_max(pilot, (start_date, pilot)) AS pilot FROM (
  SELECT *, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS day FROM pilots) GROUP BY ALL),
{plog_name} AS (
  SELECT l.*, p.pilot,
    CAST(CASE WHEN p.pilot IS NOT NULL
         THEN floor(datediff('day', p.start_date, CAST(l.ts AS DATE)) / 7) + 1 END AS INTEGER) AS pilot_wk
  FROM log l LEFT JOIN days d ON l.pilot_state = d.state AND CAST(l.ts AS DATE) = d.day
    LEFT JOIN pilots p ON p.state = d.state AND p.pilot = d.pilot){masked_ctes},
present AS (SELECT pilot, pilot_state AS state, max(pilot_wk) AS week FROM plog WHERE pilot IS NOT NULL GROUP BY ALL),
cal AS (SELECT state, pilot, start_date, lag(pilot) OVER (PARTITION BY state ORDER BY start_date, pilot) AS prior
        FROM {cal_src}),
ctx AS (
  SELECT c.pilot AS latest, c.state, p.week, c.prior FROM present p JOIN cal c ON p.pilot = c.pilot AND p.state = c.state
  ORDER BY c.start_date DESC, c.pilot DESC, c.state DESC LIMIT 1),
cum AS (
  SELECT * FROM plog
  UNION ALL
  SELECT * REPLACE (CAST(-1 AS INTEGER) AS pilot_wk) FROM plog
  WHERE pilot_wk BETWEEN 1 AND (SELECT week FROM ctx))"""


def per_cte(name: str, report_type: str, src: str = "log") -> str:
    one, two = ("INTERVAL 1 MONTH", "INTERVAL 2 MONTH") if report_type == "month" else ("INTERVAL 7 DAY",
                                                                                        "INTERVAL 14 DAY")
    return f"""{name} AS (
  SELECT *, CASE WHEN ts > (SELECT max(ts) FROM {src}) - {one} THEN 'curr'
                 WHEN ts > (SELECT max(ts) FROM {src}) - {two} THEN 'prior' ELSE 'oob' END AS period
  FROM {src})"""


def with_(*ctes: str, masked: bool = False) -> str:
    return "WITH " + ",\n".join([base_ctes(masked), *ctes]) + "\n"


def steps_cte() -> str:
    names = dict(C.EVENT_DICTIONARY)
    levels: list[str] = []
    for e in C.KEY_EVENTS:
        if names[e] not in levels:
            levels.append(names[e])
    rows = ", ".join(f"({_q(e)}, {_q(names[e])}, {levels.index(names[e]) + 1})" for e in C.KEY_EVENTS)
    return f"steps(event, event_clean, step_order) AS (VALUES {rows})"


def rename_steps(x: str) -> str:
    out = x
    for old, new in C.STEP_RENAMES:
        out = f"(CASE WHEN {x} = {_q(old)} THEN {_q(new)} ELSE {out} END)"
    return out


# --------------------------------------------------------------------------- report queries


def funnel_sql() -> str:
    return with_(per_cte("per", "month", "plog"), steps_cte(), f"""
d AS (SELECT DISTINCT pilot, distinct_id, event FROM per WHERE period = 'curr' AND event IN {_in(C.KEY_EVENTS)}),
c AS (SELECT s.event_clean, s.step_order, count(*) AS n FROM d JOIN steps s USING (event)
      GROUP BY s.event_clean, s.step_order),
l AS (SELECT *, lag(n) OVER (ORDER BY step_order) AS n_lag FROM c)""") + f"""
SELECT {rename_steps('event_clean')} AS event_clean, CAST(step_order AS INTEGER) AS step_order, n, n_lag,
       {pct(ratio('n', 'n_lag') + ' - 1.0::DOUBLE')} AS loss_share
FROM l"""


def period_kpi_ctes(rt: str) -> list[str]:
    return [per_cte("per", rt), f"""
f AS (SELECT * FROM per WHERE NOT coalesce(period = 'oob', false)
      AND NOT coalesce(event = {_q(C.CASEWORKER_INVITED)}, false)),
k0 AS (SELECT period, count(DISTINCT cbv_flow_id) AS n_sessions, count(DISTINCT distinct_id) AS n_applicants,
         count(DISTINCT CASE WHEN event = {_q(C.SHARED_INCOME_SUMMARY)} THEN cbv_flow_id END) AS n_completed,
         count(DISTINCT CASE WHEN device_type = 'smartphone' THEN cbv_flow_id END) AS n_smart,
         count(DISTINCT CASE WHEN employment_type = 'gig' THEN cbv_flow_id END) AS n_gig
       FROM f GROUP BY period),
dc_src AS (SELECT period, flow_started_minutes_ago AS v FROM f WHERE event = {_q(C.SHARED_INCOME_SUMMARY)}),
dc AS ({quantile_select('dc_src', ['period'], 'v', {'duration_complete': 0.5}, stats=False)}),
ds AS ({quantile_select('f', ['period'], 'sync_duration_seconds', {'duration_sync': 0.5}, stats=False)}),
k AS (SELECT k0.period, n_sessions, n_applicants, n_completed, duration_complete, duration_sync,
        {ratio('n_smart', 'n_sessions')} AS share_smartphone, {ratio('n_gig', 'n_completed')} AS share_gig
      FROM k0 LEFT JOIN dc USING (period) LEFT JOIN ds USING (period))"""]


def period_kpi_sql(rt: str) -> str:
    return with_(*period_kpi_ctes(rt)) + "SELECT * FROM k"


def _long(src: str, ids: list[str], metrics) -> str:
    idc = ", ".join(ids)
    return " UNION ALL ".join(f"SELECT {idc}, {_q(m)} AS metric, CAST({m} AS DOUBLE) AS value FROM {src}"
                              for m in metrics)


def _names_cte(name: str, pairs) -> str:
    rows = ", ".join(f"({_q(m)}, {_q(n)}, {i + 1})" for i, (m, n) in enumerate(pairs))
    return f"{name}(metric, metric_clean, metric_order) AS (VALUES {rows})"


def kpi_table_ctes(rt: str) -> list[str]:
    metrics = [m for m, _ in C.ADDTL_NAMES]
    return [*period_kpi_ctes(rt), _names_cte("names", C.ADDTL_NAMES), f"""
lg AS ({_long('k', ['period'], metrics)}),
t AS (SELECT n.metric, n.metric_clean, CAST(n.metric_order AS INTEGER) AS metric_order,
        max(CASE WHEN period = 'curr' THEN value END) AS curr, max(CASE WHEN period = 'prior' THEN value END) AS prior
      FROM lg JOIN names n USING (metric) GROUP BY n.metric, n.metric_clean, n.metric_order)"""]


def kpi_table_sql(rt: str) -> str:
    return with_(*kpi_table_ctes(rt)) + "SELECT * FROM t"


def _addtl_label(x: str) -> str:
    return (f"CASE WHEN contains(metric, 'share') THEN {pct(x)} "
            f"WHEN metric = 'duration_complete' THEN {timespan(x, 'mins', 0)} "
            f"WHEN metric = 'duration_sync' THEN {timespan(x, 'secs', 0)} ELSE {comma(x)} END")


def kpi_table_fmt_sql(rt: str) -> str:
    return with_(*kpi_table_ctes(rt)) + (
        f"SELECT metric, metric_clean, metric_order, {_addtl_label('curr')} AS curr, "
        f"{_addtl_label('prior')} AS prior FROM t")


def ban_kpi_sql(rt: str) -> str:
    froms = [f for f, _ in C.BAN_LOOKUP]
    metrics = ["n_started", "share_completed", "duration_complete", "share_missing_searches"]
    labels = dict(C.BAN_LABELS)
    lab_case = "CASE metric " + " ".join(f"WHEN {_q(m)} THEN {_q(labels[m])}" for m in metrics) + " END"
    order_case = "CASE metric " + " ".join(f"WHEN {_q(m)} THEN {i + 1}" for i, m in enumerate(metrics)) + " END"
    return with_(per_cte("per", rt), f"""
b AS (SELECT * FROM per WHERE event IN {_in(froms)}),
v0 AS (SELECT period,
         count(DISTINCT CASE WHEN event = {_q(C.VIEWED_AGREEMENT)} THEN distinct_id END) AS s,
         count(DISTINCT CASE WHEN event = {_q(C.SHARED_INCOME_SUMMARY)} THEN distinct_id END) AS c,
         sum(CASE WHEN event = {_q(C.SEARCHED_EMPLOYER)} THEN 1 ELSE 0 END) AS searches,
         sum(CASE WHEN event = {_q(C.MISSING_RESULTS)} THEN 1 ELSE 0 END) AS missing
       FROM b GROUP BY period),
dc_src AS (SELECT period, flow_started_minutes_ago AS v FROM b WHERE event = {_q(C.SHARED_INCOME_SUMMARY)}),
dc AS ({quantile_select('dc_src', ['period'], 'v', {'duration_complete': 0.5}, stats=False)}),
v AS (SELECT v0.period, CAST(s AS DOUBLE) AS n_started, {ratio('c', 's')} AS share_completed, duration_complete,
        {ratio('missing', 'searches')} AS share_missing_searches
      FROM v0 LEFT JOIN dc USING (period)),
lg AS ({_long('v', ['period'], metrics)}),
w AS (SELECT metric, max(CASE WHEN period = 'curr' THEN value END) AS curr,
        max(CASE WHEN period = 'prior' THEN value END) AS prior FROM lg GROUP BY metric),
d AS (SELECT *, curr / nullif(prior, 0) - 1.0::DOUBLE AS delta FROM w)""") + f"""
SELECT metric, CAST({order_case} AS INTEGER) AS metric_order, curr, prior, delta, {lab_case} AS label,
  CASE WHEN contains(metric, 'share') THEN {pct('curr')}
       WHEN metric = 'duration_complete' THEN {number('curr', 1, 'm')}
       ELSE {short_scale('curr', 1)} END AS curr_fmt,
  CASE WHEN delta > 0 THEN 'up' WHEN delta < 0 THEN 'down' END AS direction,
  CASE WHEN delta IS NULL THEN {_q(C.NO_PRIOR)}
       WHEN delta BETWEEN -0.005::DOUBLE AND 0.005::DOUBLE THEN {_q(C.NO_CHANGE)}
       ELSE {pct('abs(delta)')} || ' from last {rt}' END AS delta_fmt
FROM d"""


def _max_date() -> str:
    return "(SELECT CAST(max(ts) AS DATE) FROM log)"


def trend_ctes() -> list[str]:
    froms = [f for f, _ in C.TREND_LOOKUP]
    return [f"""
tr AS (SELECT {_case('event', C.TREND_LOOKUP)} AS event, CAST(ts AS DATE) AS date, count(*) AS n
       FROM log WHERE event IN {_in(froms)}
         AND ts >= CAST(CAST({_max_date()} - INTERVAL 1 MONTH AS DATE) AS TIMESTAMP)
       GROUP BY 1, 2)"""]


def search_ctes() -> list[str]:
    prio = (f"CASE event WHEN {_q(C.SEARCH_TIE_PRIORITY[0])} THEN 1 WHEN {_q(C.SEARCH_TIE_PRIORITY[1])} THEN 2 "
            f"ELSE 3 END")
    sel = dict(C.EVENT_DICTIONARY)[C.SELECTED_EMPLOYER]
    return [f"""
s0 AS (SELECT *, {_case('event', C.EVENT_DICTIONARY)} AS event_clean, {prio} AS prio FROM log
       WHERE NOT coalesce(event IN {_in(C.SEARCH_IGNORED_EVENTS)}, false)),
s1 AS (SELECT *, CASE WHEN cbv_flow_id IS NOT NULL THEN lead(event_clean) OVER (PARTITION BY cbv_flow_id
         ORDER BY distinct_id ASC NULLS LAST, ts ASC NULLS LAST, prio, event ASC NULLS LAST, event_id) END
         AS lead_event FROM s0),
sl AS (SELECT event_id, distinct_id, cbv_flow_id, ts, query, lead_event, {normalize('query')} AS query_clean
       FROM s1 WHERE event = {_q(C.SEARCHED_EMPLOYER)}),
so AS (SELECT *, lead_event = {_q(sel)} AS is_successful FROM sl WHERE lead_event IS NOT NULL),
cnt AS (SELECT is_successful, query_clean, count(*) AS n FROM so GROUP BY 1, 2),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY is_successful
          ORDER BY n DESC, query_clean ASC NULLS LAST) AS INTEGER) AS rank FROM cnt) WHERE rank <= {10}),
tops AS (SELECT is_successful, query_clean, n, rank, upper(query_clean) || ' (' || CAST(n AS VARCHAR) || ')'
           AS event_count FROM top)"""]


# --------------------------------------------------------------------------- weekly queries


def weekly_wide_ctes() -> list[str]:
    froms = [f for f, _ in C.WEEKLY_LOOKUP]
    roles = list(dict.fromkeys(t for _, t in C.WEEKLY_LOOKUP))
    piv = ", ".join(f"CAST(coalesce(max(CASE WHEN event_ban = {_q(r)} THEN value END), 0) AS BIGINT) AS {r}"
                    for r in roles)
    return [f"""
wb AS (SELECT *, {_case('event', C.WEEKLY_LOOKUP)} AS event_ban FROM cum WHERE event IN {_in(froms)}),
wa AS (SELECT pilot_state, pilot, pilot_wk, event_ban,
         count(DISTINCT distinct_id) + max(CAST(distinct_id IS NULL AS INTEGER)) AS applicants,
         count(*) AS events FROM wb GROUP BY pilot_state, pilot, pilot_wk, event_ban),
wl AS (SELECT pilot_state, pilot, pilot_wk, event_ban, 'applicants' AS denom, applicants AS value FROM wa
       UNION ALL SELECT pilot_state, pilot, pilot_wk, event_ban, 'events', events FROM wa),
wide AS (SELECT pilot_state, pilot, pilot_wk, denom, {piv} FROM wl GROUP BY pilot_state, pilot, pilot_wk, denom)"""]


def multi_ctes() -> list[str]:
    return [f"""
fs AS (SELECT pilot_state, pilot, pilot_wk, distinct_id, coalesce(employer_name, {_q(C.NOT_CAPTURED)}) AS emp
       FROM cum WHERE event = {_q(C.FINISHED_SYNC)}),
pp AS (SELECT pilot_state, pilot, pilot_wk, distinct_id, count(*) AS submissions
       FROM (SELECT DISTINCT * FROM fs) GROUP BY pilot_state, pilot, pilot_wk, distinct_id),
multi AS (SELECT pilot_state, pilot, pilot_wk, 'applicants' AS denom, count(*) AS multi_employers
          FROM pp WHERE submissions > 1 GROUP BY pilot_state, pilot, pilot_wk)"""]


KPI_COUNTS = {"started": "n_started", "error": "n_error", "help": "n_help", "invitation": "n_invitation",
              "copied_invite": "n_copied_invite", "multi_employers": "n_multi_employers"}
KPI_SHARES = ("share_complete", "share_tokenized", "share_search_missing", "share_login_success")


def weekly_kpi_ctes() -> list[str]:
    metrics = list(KPI_COUNTS.values()) + list(KPI_SHARES)
    counts = ", ".join(f"{k} AS {v}" for k, v in KPI_COUNTS.items())
    return [*weekly_wide_ctes(), *multi_ctes(), f"""
meas AS (SELECT w.pilot_state, w.pilot, w.pilot_wk, w.denom, {counts.replace('multi_employers AS', 'm.multi_employers AS')},
    {ratio('completed', 'started')} AS share_complete,
    {ratio('initiation_token', 'initiation_generic + initiation_generic_restart + initiation_token')} AS share_tokenized,
    {ratio('search_missing', 'search')} AS share_search_missing,
    {ratio('login_success', 'login_attempt')} AS share_login_success
  FROM wide w LEFT JOIN multi m ON w.pilot_state IS NOT DISTINCT FROM m.pilot_state
    AND w.pilot IS NOT DISTINCT FROM m.pilot AND w.pilot_wk IS NOT DISTINCT FROM m.pilot_wk
    AND w.denom IS NOT DISTINCT FROM m.denom),
rel AS (SELECT * EXCLUDE (pilot), CASE WHEN pilot = (SELECT latest FROM ctx) THEN 'curr'
          WHEN pilot = (SELECT prior FROM ctx) THEN 'prior' END AS pilot_rel FROM meas),
kl AS ({_long("(SELECT * FROM rel WHERE pilot_rel IS NOT NULL)", ['pilot_state', 'pilot_wk', 'denom', 'pilot_rel'],
              metrics)}),
kw AS (SELECT pilot_state, pilot_wk, denom, metric, max(CASE WHEN pilot_rel = 'curr' THEN value END) AS curr,
         max(CASE WHEN pilot_rel = 'prior' THEN value END) AS prior
       FROM kl GROUP BY pilot_state, pilot_wk, denom, metric),
kd AS (SELECT *, curr - prior AS delta, (curr - prior) / nullif(prior, 0) AS delta_pct FROM kw),
wk AS (SELECT pilot_state, pilot_wk, denom, metric, curr, prior, delta, delta_pct,
  CASE WHEN starts_with(metric, 'n_') THEN {comma('curr')} ELSE {pct('curr')} END AS val_fmt,
  CASE WHEN delta > 0 THEN 'up' WHEN delta < 0 THEN 'down' END AS direction,
  CASE WHEN prior IS NULL THEN {_q(C.NO_PRIOR)} WHEN curr IS NULL THEN NULL
       WHEN delta_pct BETWEEN -0.005::DOUBLE AND 0.005::DOUBLE THEN {_q(C.NO_CHANGE)}
       WHEN starts_with(metric, 'n_') THEN {comma('abs(delta)')} || ' from last run'
       WHEN starts_with(metric, 'share_') THEN {pct('abs(delta)')} || ' points from last run'
       ELSE {_q(C.NO_CHANGE)} END AS text_fmt
  FROM kd)"""]


def _init_case(x: str = "event") -> str:
    return (f"CASE {x} WHEN {_q(C.CLICKED_INVITATION)} THEN 'Invitation' "
            f"WHEN {_q(C.CLICKED_GENERIC)} THEN 'Clicked Generic Link' END")


def filled_ctes() -> list[str]:
    def fill(c: str) -> str:
        w = "PARTITION BY distinct_id, cbv_flow_id ORDER BY ts ASC NULLS LAST, event_id"
        return (f"coalesce({c}, first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED "
                f"FOLLOWING), last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND "
                f"CURRENT ROW))")
    keep = _in(C.DEVICE_KEEP)
    return [f"""
fi0 AS (SELECT *, {_init_case()} AS initiation FROM plog),
fi1 AS (SELECT * REPLACE ({fill('device_type')} AS device_type, {fill('origin')} AS origin,
          {fill('initiation')} AS initiation) FROM fi0),
filled AS (SELECT * REPLACE (CASE WHEN coalesce(device_type, 'unknown') IN {keep} THEN coalesce(device_type, 'unknown')
             ELSE 'other' END AS device_type, coalesce(origin, 'unknown') AS origin,
             coalesce(initiation, 'unknown') AS initiation) FROM fi1)"""]


def device_mix_sql() -> str:
    order = "CASE device_type " + " ".join(f"WHEN {_q(d)} THEN {i + 1}" for i, d in enumerate(C.DEVICE_ORDER)) + " END"
    return with_(*filled_ctes(), f"""
fc AS (SELECT * FROM filled UNION ALL SELECT * REPLACE (CAST(-1 AS INTEGER) AS pilot_wk) FROM filled
       WHERE pilot_wk BETWEEN 1 AND (SELECT week FROM ctx)),
fe AS (SELECT *, CASE WHEN event = {_q(C.VIEWED_AGREEMENT)} THEN 1 ELSE 0 END AS st,
         CASE WHEN event = {_q(C.SHARED_INCOME_SUMMARY)} THEN 1 ELSE 0 END AS co
       FROM fc WHERE event IN {_in([C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY])}),
fl AS (SELECT pilot, pilot_wk, distinct_id, cbv_flow_id, device_type, origin, initiation, sum(st) AS started,
         sum(co) AS completed FROM fe GROUP BY ALL),
wkly AS (SELECT pilot, pilot_wk, device_type, CAST(sum(started) AS BIGINT) AS started,
           CAST(sum(completed) AS BIGINT) AS completed FROM fl GROUP BY pilot, pilot_wk, device_type),
r AS (SELECT *, {ratio('completed', 'started')} AS completion_rate,
        {ratio('started', 'sum(started) OVER (PARTITION BY pilot, pilot_wk)')} AS share FROM wkly)""") + f"""
SELECT pilot, pilot_wk, device_type, CAST({order} AS INTEGER) AS device_order, started, completed, completion_rate,
  share, {pct('completion_rate')} AS completion_rate_fmt, {pct('share')} AS share_fmt,
  CASE WHEN device_type IN ('smartphone', 'desktop') THEN upper(left(device_type, 1)) || lower(substr(device_type, 2))
    || chr(10) || 'device share: ' || {pct('share')} || chr(10) || 'completion rate: ' || {pct('completion_rate')}
  END AS lab_share
FROM r"""


def duration_ctes() -> list[str]:
    return [f"""
du0 AS (SELECT pilot, pilot_wk, employment_type, sync_duration_seconds, flow_started_minutes_ago FROM cum
        WHERE event IN {_in([C.FINISHED_SYNC, C.SHARED_INCOME_SUMMARY])}),
du1 AS (SELECT pilot, pilot_wk, employment_type, 'sync_duration_seconds' AS metric, sync_duration_seconds AS value
        FROM du0 WHERE sync_duration_seconds IS NOT NULL
        UNION ALL SELECT pilot, pilot_wk, employment_type, 'flow_started_minutes_ago', flow_started_minutes_ago
        FROM du0 WHERE flow_started_minutes_ago IS NOT NULL),
dur AS ({quantile_select('du1', ['pilot', 'pilot_wk', 'metric', 'employment_type'], 'value',
                         {'q25': 0.25, 'median': 0.5, 'q75': 0.75})})"""]


def weekly_funnel_ctes() -> list[str]:
    return [steps_cte(), f"""
fr AS (SELECT DISTINCT pilot, pilot_wk, distinct_id, event FROM cum WHERE event IN {_in(C.KEY_EVENTS)}),
fj AS (SELECT fr.*, s.event_clean, s.step_order, CASE WHEN pilot = (SELECT latest FROM ctx) THEN 'curr'
         WHEN pilot = (SELECT prior FROM ctx) THEN 'prior' END AS pilot_rel FROM fr JOIN steps s USING (event)),
fcnt AS (SELECT pilot_rel, pilot_wk, event_clean, step_order, count(*) AS n FROM fj WHERE pilot_rel IS NOT NULL
         GROUP BY ALL),
fw AS (SELECT pilot_wk, event_clean, step_order, max(CASE WHEN pilot_rel = 'curr' THEN n END) AS curr,
         max(CASE WHEN pilot_rel = 'prior' THEN n END) AS prior FROM fcnt GROUP BY pilot_wk, event_clean, step_order),
wf AS (SELECT pilot_wk, {rename_steps('event_clean')} AS event_clean, CAST(step_order AS INTEGER) AS step_order,
         CAST(curr AS BIGINT) AS curr, CAST(prior AS BIGINT) AS prior,
         CAST(lag(curr) OVER (PARTITION BY pilot_wk ORDER BY curr IS NULL, step_order) AS BIGINT) AS curr_lag
       FROM fw)"""]


def daily_ctes() -> list[str]:
    return [f"""
dd AS (SELECT pilot, pilot_wk, CAST(ts AS DATE) AS day, count(*) AS n FROM plog
       WHERE pilot_wk BETWEEN 1 AND (SELECT week FROM ctx) AND event = {_q(C.VIEWED_AGREEMENT)} GROUP BY ALL),
daily AS (SELECT *, CAST(sum(n) OVER (PARTITION BY pilot, pilot_wk) AS BIGINT) AS week_total FROM dd),
dtot AS (SELECT pilot, CAST(sum(n) AS BIGINT) AS n FROM daily GROUP BY pilot),
dtot2 AS (SELECT pilot, n, {short_scale('n', 0)} || ' cum. in ' || pilot AS pilot_cum FROM dtot)"""]


def mask_sql() -> str:
    return with_(f"""
ids AS (SELECT DISTINCT distinct_id FROM plog WHERE distinct_id IS NOT NULL),
rk AS (SELECT distinct_id, row_number() OVER (ORDER BY md5(distinct_id || {_q(C.MASK_SEED)}), distinct_id) AS rn,
         count(*) OVER () AS n FROM ids),
chosen AS (SELECT distinct_id FROM rk WHERE rn <= floor(n::DOUBLE * {C.MASK_SHARE!r}::DOUBLE)),
bothx AS (SELECT event_id, event, ts, distinct_id, cbv_flow_id, pilot, pilot_wk, false AS is_copy FROM plog
          UNION ALL
          SELECT event_id, event, ts, distinct_id || '-c', cbv_flow_id + 1000000, pilot, pilot_wk, true FROM plog
          WHERE distinct_id IN (SELECT distinct_id FROM chosen)),
sh AS (SELECT * REPLACE (ts + INTERVAL {C.MASK_DAYS} DAY + INTERVAL {C.MASK_YEARS} YEAR AS ts) FROM bothx),
fd AS (SELECT pilot, strftime(min(CAST(ts AS DATE)), '%b %Y') AS label FROM sh WHERE pilot IS NOT NULL
       GROUP BY pilot)""") + f"""
SELECT event_id, event, ts AS "timestamp", distinct_id, cbv_flow_id, fd.label AS pilot, pilot_wk,
  {_q(C.MASK_STATE)} AS pilot_state, is_copy
FROM sh LEFT JOIN fd USING (pilot)"""


# --------------------------------------------------------------------------- registry


def _sql_all() -> dict[str, str]:
    out: dict[str, str] = {}
    log_cols = ("CAST(event_id AS VARCHAR) AS event_id, event, ts AS \"timestamp\", distinct_id, cbv_flow_id, pilot_state, sync_duration_seconds, "
                "flow_started_minutes_ago, device_type, employment_type, employer_name, query")
    out["scan_props"] = with_() + f"SELECT {log_cols} FROM log"
    out["applicant_only"] = with_() + "SELECT CAST(event_id AS VARCHAR) AS event_id, event, distinct_id, origin FROM log WHERE starts_with(event, 'Applicant')"
    out["cast_units"] = with_() + (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, cbv_flow_id, sync_duration_seconds, flow_started_minutes_ago FROM log "
        f"WHERE event IN {_in([C.FINISHED_SYNC, C.SHARED_INCOME_SUMMARY])}")
    out["range_extract"] = with_(f"""
win AS (SELECT greatest((SELECT max(start_date) FROM pilots WHERE client_agency = 'tst'),
          CAST({_max_date()} - INTERVAL 2 MONTH AS DATE)) AS s, {_max_date()} AS e)""") + (
        "SELECT event_id, event, ts AS \"timestamp\", distinct_id FROM log, win WHERE CAST(ts AS DATE) BETWEEN s AND e")
    out["stream_ingest"] = with_() + (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, event, ts AS \"timestamp\", distinct_id, cbv_flow_id, 'tst' AS client_agency, "
        "CAST(ts AS DATE) AS event_date FROM log")
    out["pilot_week"] = with_() + "SELECT event_id, pilot_state, pilot, pilot_wk FROM plog"
    out["recode_events"] = with_() + (
        f"SELECT event, {_case('event', C.WEEKLY_LOOKUP)} AS event_ban, count(*) AS n FROM log GROUP BY 1, 2")
    out["funnel"] = funnel_sql()
    out["roundtrip_parquet"] = funnel_sql()
    out["filter_out"] = with_(per_cte("per", "week")) + (
        "SELECT period, device_type, count(*) AS n FROM per WHERE NOT coalesce(period = 'oob', false) "
        "AND NOT coalesce(device_type = 'tablet', false) GROUP BY 1, 2")
    out["period_class"] = with_(per_cte("pm", "month"), per_cte("pw", "week")) + (
        "SELECT 'month' AS report_type, period, count(*) AS n FROM pm GROUP BY period "
        "UNION ALL SELECT 'week', period, count(*) FROM pw GROUP BY period")
    out["latest_pilot"] = with_() + "SELECT (SELECT latest FROM ctx) AS pilot_latest, count(*) AS n_events FROM plog"
    out["prior_pilot"] = with_() + "SELECT state AS pilot_state, latest AS pilot_latest, prior AS pilot_prior FROM ctx"
    out["latest_week"] = with_() + (
        "SELECT (SELECT latest FROM ctx) AS pilot_latest, (SELECT week FROM ctx) AS pilot_week, count(*) AS n_events "
        "FROM plog WHERE pilot = (SELECT latest FROM ctx)")
    out["extract_window"] = with_(f"""
pw0 AS (SELECT *, least({_max_date()}, end_date) AS api_end FROM pilots
        WHERE NOT coalesce(start_date > {_max_date()}, false)),
pw1 AS (SELECT *, CAST(start_date AS VARCHAR) || '_to_' || CAST(api_end AS VARCHAR) AS path_dates FROM pw0),
pw2 AS (SELECT *, lag(path_dates) OVER (ORDER BY start_date, pilot) AS prior_path_dates,
          row_number() OVER (ORDER BY start_date DESC, pilot DESC) AS rn FROM pw1)""") + (
        "SELECT start_date, api_end, client_agency, path_dates, prior_path_dates, "
        "(SELECT count(*) FROM log WHERE CAST(ts AS DATE) BETWEEN pw2.start_date AND pw2.api_end) AS n_events "
        "FROM pw2 WHERE rn = 1")
    out["cumulative_week"] = with_() + "SELECT pilot, pilot_wk, count(*) AS n FROM cum GROUP BY 1, 2"
    out["report_period"] = with_(f"""
rp AS (SELECT min(CAST(ts AS DATE)) AS date_start, max(CAST(ts AS DATE)) AS date_end FROM log)""") + """
SELECT date_start, date_end, greatest(date_start, CAST(date_end - INTERVAL 1 MONTH AS DATE)) AS period_start,
  CASE WHEN year(date_start) = year(date_end) AND month(date_start) = month(date_end)
       THEN strftime(date_start, '%B %d') || ' - ' || strftime(date_end, '%d')
       ELSE strftime(date_start, '%B %d') || ' - ' || strftime(date_end, '%B %d') END AS period
FROM rp"""
    out["period_kpi"] = period_kpi_sql("week")
    out["period_kpi_month"] = period_kpi_sql("month")
    out["kpi_table"] = kpi_table_sql("month")
    out["kpi_table_fmt"] = kpi_table_fmt_sql("week")
    out["ban_kpi"] = ban_kpi_sql("week")
    out["ban_kpi_month"] = ban_kpi_sql("month")
    out["trend"] = with_(*trend_ctes()) + "SELECT * FROM tr"
    out["weekend_days"] = with_(*trend_ctes()) + (
        "SELECT DISTINCT date, strftime(date, '%A') AS weekday FROM tr WHERE dayofweek(date) IN (0, 6)")
    out["search_lead"] = with_(*search_ctes()) + (
        "SELECT event_id, distinct_id, cbv_flow_id, ts AS \"timestamp\", query, lead_event, query_clean FROM sl")
    out["search_normalize"] = with_() + (
        f"SELECT query, {normalize('query')} AS query_clean, count(*) AS n FROM log WHERE query IS NOT NULL "
        "GROUP BY 1, 2")
    out["top_searches"] = with_(*search_ctes()) + "SELECT * FROM tops"
    out["search_line"] = with_(*search_ctes()) + (
        "SELECT is_successful, string_agg(event_count, '; ' ORDER BY rank) AS line FROM tops GROUP BY is_successful")
    out["fmt_labels"] = with_("""
fe0 AS (SELECT event, count(*) AS n FROM log GROUP BY event),
fe1 AS (SELECT *, n / sum(n) OVER () AS share FROM fe0)""") + f"""
SELECT event, n, {pct('share')} AS pct, {pct('share - 0.06::DOUBLE')} AS pct_delta, {comma('n * 997')} AS comma,
  {number('n / 7', 1, 'm')} AS number_m, {short_scale('n::DOUBLE * 1234.5::DOUBLE', 1)} AS short,
  {short_scale('n', 1, 0)} AS short_count, {timespan('n / 3', 'mins', 0)} AS span_mins,
  {timespan('n / 3', 'secs', 0)} AS span_secs
FROM fe1"""
    out["weekly_events_applicants"] = with_(*weekly_wide_ctes()) + "SELECT * FROM wide"
    out["multi_employer"] = with_(*multi_ctes()) + "SELECT * FROM multi"
    out["weekly_kpi"] = with_(*weekly_kpi_ctes()) + "SELECT * FROM wk"
    out["initiation_label"] = with_() + f"SELECT event, {_init_case()} AS initiation, count(*) AS n FROM log GROUP BY 1, 2"
    out["fill_updown"] = with_(*filled_ctes()) + "SELECT event_id, device_type, origin, initiation FROM filled"
    out["device_mix"] = device_mix_sql()
    out["duration_stats"] = with_(*duration_ctes()) + "SELECT * FROM dur"
    out["weekly_funnel"] = with_(*weekly_funnel_ctes()) + (
        f"SELECT *, {pct(ratio('curr', 'curr_lag') + ' - 1.0::DOUBLE')} AS loss_share FROM wf")
    out["initiations_daily"] = with_(*daily_ctes()) + f"""
SELECT pilot, pilot_wk, day, n, week_total, pilot_wk = (SELECT week FROM ctx) AS is_latest_week,
  'Week ' || CAST(pilot_wk AS VARCHAR) || ' [n = ' || {short_scale('week_total', 1, 0)} || ']' AS week_label
FROM daily"""
    out["initiations_daily_total"] = with_(*daily_ctes()) + "SELECT * FROM dtot2"
    out["initiations_caption"] = with_(*daily_ctes()) + (
        "SELECT string_agg(pilot_cum, ' vs. ' ORDER BY pilot, pilot_cum) AS caption FROM dtot2")
    sub_names = [C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY]
    piv = ", ".join(f"CAST(coalesce(max(CASE WHEN event = {_q(n)} THEN value END), 0) AS BIGINT) AS {n}"
                    for n in sub_names)
    out["submission_share"] = with_(f"""
sb AS (SELECT pilot, event, count(DISTINCT distinct_id) + max(CAST(distinct_id IS NULL AS INTEGER)) AS applicants,
         count(*) AS events FROM cum WHERE pilot = (SELECT latest FROM ctx) AND pilot_wk > 0
         AND event IN {_in(sub_names)} GROUP BY pilot, event),
sl2 AS (SELECT pilot, event, 'applicants' AS denom, applicants AS value FROM sb
        UNION ALL SELECT pilot, event, 'events', events FROM sb),
sw AS (SELECT pilot, denom, {piv} FROM sl2 GROUP BY pilot, denom)""") + (
        f"SELECT *, {ratio(C.SHARED_INCOME_SUMMARY, C.VIEWED_AGREEMENT)} AS share FROM sw")
    out["mask_copies"] = mask_sql()
    cards = ", ".join(f"({_q(d)}, {_q(m)}, {_q(t)}, {i + 1})" for i, (d, m, t) in enumerate(C.DASHBOARD_CARDS))
    out["kpi_cards"] = with_(*weekly_kpi_ctes(), f"cards(denom, metric, title, card_order) AS (VALUES {cards})") + """
SELECT CAST(c.card_order AS INTEGER) AS card_order, c.title, c.denom, c.metric, k.val_fmt, k.text_fmt, k.direction
FROM cards c LEFT JOIN (SELECT * FROM wk WHERE pilot_wk = -1) k ON c.denom = k.denom AND c.metric = k.metric"""
    out["narrative"] = with_(f"""
inv AS (SELECT count(*) AS i FROM cum WHERE pilot_wk = -1 AND pilot = (SELECT latest FROM ctx)
        AND event = {_q(C.CASEWORKER_INVITED)})""") + f"""
SELECT CAST((SELECT week FROM ctx) AS VARCHAR) || ' (cum.)' AS week_disp, (SELECT state FROM ctx) AS pilot_state,
  (SELECT latest FROM ctx) AS pilot_latest, (SELECT prior FROM ctx) AS pilot_prior,
  i AS invitations, {comma('i')} AS invitations_fmt
FROM inv"""
    out["weekly_kpi_masked"] = with_(*weekly_kpi_ctes(), masked=True) + "SELECT * FROM wk"
    out["report_funnel_labels"] = (f"SELECT *, event_clean || ' (' || {short_scale('n', 1, 0)} || ')' AS label "
                                   f"FROM ({funnel_sql()})")
    out["funnel_labels"] = with_(*weekly_funnel_ctes()) + f"""
SELECT event_clean, step_order, curr, curr_lag, {pct(ratio('curr', 'curr_lag') + ' - 1.0::DOUBLE')} AS loss_share,
  event_clean || ' (n = ' || {short_scale('curr', 1, 0)} || ')' AS label
FROM wf WHERE pilot_wk = -1"""
    out["duration_labels"] = with_(*duration_ctes()) + f"""
SELECT metric, pilot, employment_type, n, median, pilot || ' (n = ' || {comma('n')} || ')' AS label,
  {number('median', 1, 'm')} AS median_fmt
FROM dur WHERE pilot_wk = -1 AND metric = 'flow_started_minutes_ago'
UNION ALL
SELECT metric, pilot, employment_type, n, median, employment_type || ' (n = ' || {comma('n')} || ')' AS label,
  {number('median', 0, 's')} AS median_fmt
FROM dur WHERE pilot_wk = -1 AND metric = 'sync_duration_seconds' AND employment_type IS NOT NULL"""
    out["extract_once"] = with_("""
span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM log),
every AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS event_date FROM span),
n AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_events FROM log GROUP BY ALL)""") + """
SELECT event_date, CAST(1 AS BIGINT) AS n_asked, coalesce(n_events, 0) AS n_events FROM every LEFT JOIN n USING (event_date)"""
    out["late_keys"] = with_()[:-1] + """
SELECT event_id, event, origin AS link_origin, CAST(cbv_flow_id AS VARCHAR) AS flow, CAST(NULL AS VARCHAR) AS never_sent FROM log"""
    out["export_quarantine"] = with_()[:-1] + """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'unreadable' WHEN event_id % 89 = 1 THEN 'no timestamp' END AS reason FROM log"""
    for name in ("weekly_kpi", "weekly_funnel", "trend", "submission_share"):  # from the rollup: the same tables
        out[f"rollup_{name}"] = out[name]
    published = {"report_period": out["report_period"], "report_dropoff": out["funnel"], "report_addtl": kpi_table_fmt_sql("month"),
                 "report_ban": out["ban_kpi_month"], "report_trend": out["trend"], "report_searches": out["top_searches"],
                 "wkly_ban": out["weekly_kpi"], "wkly_device_origin": out["device_mix"], "wkly_duration": out["duration_stats"],
                 "wkly_dropoff": out["weekly_funnel"]}
    out.update({f"published_{name}": sql for name, sql in published.items()})
    return out


ORACLE_SQL: dict[str, str] = _sql_all()
