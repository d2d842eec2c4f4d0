"""Run parameters and the event vocabularies the metrics are defined over.

What a run may change (funnel steps, event dictionary, pilots, agency, period,
dates) is passed in through :class:`Params`.  The event names, the roles events
play in the cards, trend and weekly KPIs, and the titles are constants here.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --- fixed values: event names of the verification flow ----------------------
# These are the event names the report metrics are defined over; they must equal
# the names in the analytics export, so they are stated here as plain text.
CASEWORKER_INVITED = "CaseworkerInvitedApplicantToFlow"
VIEWED_AGREEMENT = "ApplicantViewedAgreement"
SHARED_INCOME_SUMMARY = "ApplicantSharedIncomeSummary"
SEARCHED_EMPLOYER = "ApplicantSearchedForEmployer"
MISSING_RESULTS = "ApplicantAccessedMissingResultsPage"
SELECTED_EMPLOYER = "ApplicantSelectedEmployerOrPlatformItem"
BEGAN_LINKING = "ApplicantBeganLinkingEmployer"
FINISHED_SYNC = "ApplicantFinishedSync"
CLICKED_INVITATION = "ApplicantClickedCBVInvitationLink"
CLICKED_GENERIC = "ApplicantClickedGenericLink"

# Standard report, big-number cards: event -> measure role.
BAN_LOOKUP: tuple[tuple[str, str], ...] = (
    ("ApplicantViewedAgreement", "n_started"),
    ("ApplicantSharedIncomeSummary", "n_completed"),
    ("ApplicantSearchedForEmployer", "n_searches"),
    ("ApplicantAccessedMissingResultsPage", "n_searches_missing"),
)

# Standard report, daily trend: event -> series title (also the series order).
TREND_LOOKUP: tuple[tuple[str, str], ...] = (
    ("CaseworkerInvitedApplicantToFlow", "Invitations Sent to Applicants"),
    ("ApplicantViewedAgreement", "Sessions Started"),
    ("ApplicantSharedIncomeSummary", "Sessions Completed"),
)

# Weekly dashboard: event -> KPI role (two events share the role "help").
WEEKLY_LOOKUP: tuple[tuple[str, str], ...] = (
    ("ApplicantClickedCBVInvitationLink", "initiation_token"),
    ("ApplicantClickedGenericLink", "initiation_generic"),
    ("ApplicantRestartedWithGenericLinkOnTimeout", "initiation_generic_restart"),
    ("ApplicantViewedAgreement", "started"),
    ("ApplicantSharedIncomeSummary", "completed"),
    ("ApplicantAttemptedLogin", "login_attempt"),
    ("ApplicantSucceededWithLogin", "login_success"),
    ("ApplicantOpenedHelpModal", "help"),
    ("ApplicantViewedHelpTopic", "help"),
    ("ApplicantSearchedForEmployer", "search"),
    ("ApplicantAccessedMissingResultsPage", "search_missing"),
    ("ApplicantEncounteredError", "error"),
    ("CaseworkerInvitedApplicantToFlow", "invitation"),
    ("ApplicantFinishedSync", "synced"),
    ("ApplicantCopiedInvitationLink", "copied_invite"),
)

# Help events left out of the search-outcome sequence.
SEARCH_IGNORED_EVENTS: tuple[str, ...] = (
    "ApplicantViewedHelpText",
    "ApplicantOpenedHelpModal",
    "ApplicantViewedHelpTopic",
)

# Events that sort first when two events share a timestamp (search outcome).
SEARCH_TIE_PRIORITY: tuple[str, ...] = (
    "ApplicantSelectedEmployerOrPlatformItem",
    "ApplicantBeganLinkingEmployer",
)

# Words removed from employer searches after punctuation is dropped.
SEARCH_STOP_WORDS: tuple[str, ...] = ("inc", "llc", "ltd", "co", "corp", "the")

# Device labels kept as they are; any other value becomes "other".
DEVICE_KEEP: tuple[str, ...] = ("desktop", "smartphone", "unknown")
# Display order of device types.
DEVICE_ORDER: tuple[str, ...] = ("desktop", "other", "unknown", "smartphone")

# Event dictionary: raw event -> readable name.  The reference loads this from an
# external package; these readable names are our defaults ("Agreed" and
# "Selected Employer" are the two names the report code relies on).
EVENT_DICTIONARY: tuple[tuple[str, str], ...] = (
    ("ApplicantClickedCBVInvitationLink", "Clicked Invitation Link"),
    ("ApplicantClickedGenericLink", "Clicked Generic Link"),
    ("ApplicantRestartedWithGenericLinkOnTimeout", "Restarted After Timeout"),
    ("ApplicantViewedAgreement", "Agreed"),
    ("ApplicantSearchedForEmployer", "Searched Employer"),
    ("ApplicantAccessedMissingResultsPage", "Missing Results"),
    ("ApplicantSelectedEmployerOrPlatformItem", "Selected Employer"),
    ("ApplicantBeganLinkingEmployer", "Began Linking"),
    ("ApplicantAttemptedLogin", "Attempted Login"),
    ("ApplicantSucceededWithLogin", "Logged In"),
    ("ApplicantFinishedSync", "Finished Sync"),
    ("ApplicantSharedIncomeSummary", "Shared Income Summary"),
    ("ApplicantOpenedHelpModal", "Opened Help"),
    ("ApplicantViewedHelpTopic", "Viewed Help Topic"),
    ("ApplicantViewedHelpText", "Viewed Help Text"),
    ("ApplicantEncounteredError", "Encountered Error"),
    ("ApplicantCopiedInvitationLink", "Copied Invitation Link"),
    ("CaseworkerInvitedApplicantToFlow", "Invited Applicant"),
)

# Funnel steps in journey order (raw event names); the step order is the
# position of the readable name in this list.
KEY_EVENTS: tuple[str, ...] = (
    "ApplicantViewedAgreement",
    "ApplicantSearchedForEmployer",
    "ApplicantSelectedEmployerOrPlatformItem",
    "ApplicantBeganLinkingEmployer",
    "ApplicantAttemptedLogin",
    "ApplicantSucceededWithLogin",
    "ApplicantFinishedSync",
    "ApplicantSharedIncomeSummary",
)

# Readable step renamed after ordering.
STEP_RENAMES: tuple[tuple[str, str], ...] = (("Agreed", "Consented"),)

# Readable names of the metrics in the additional-metrics table.
ADDTL_NAMES: tuple[tuple[str, str], ...] = (
    ("n_sessions", "Number of Sessions"),
    ("n_applicants", "Distinct Applicants"),
    ("n_completed", "Number of Completed Sessions"),
    ("duration_complete", "Time to Complete (Median, Min.)"),
    ("duration_sync", "Payroll Provider Sync Time (Median, Sec.)"),
    ("share_smartphone", "Share Smartphones (Sessions)"),
    ("share_gig", "Share Gig (Sessions of Completed)"),
)

# Card labels of the standard report.
BAN_LABELS: tuple[tuple[str, str], ...] = (
    ("n_started", "Verifications\nStarted"),
    ("share_completed", "Completion\nRate"),
    ("duration_complete", "Time to\nComplete"),
    ("share_missing_searches", "Missing\nSearch Results"),
)

# Headline cards of the weekly dashboard: (denominator, metric, title).
DASHBOARD_CARDS: tuple[tuple[str, str, str], ...] = (
    ("applicants", "n_started", "Income Verification Started"),
    ("applicants", "share_complete", "Completion Rate"),
    ("events", "share_tokenized", "Tokenized Link Share"),
    ("applicants", "share_login_success", "Successful Account Logins"),
    ("applicants", "n_multi_employers", "Multi Employer Submissions"),
    ("events", "share_search_missing", "Missing Search Results"),
    ("events", "n_copied_invite", "Copied Invitation Link"),
)

NOT_CAPTURED = "[not captured]"
NO_PRIOR = "No prior period"
NO_CHANGE = "No change"
CUMULATIVE_WEEK = -1


@dataclass(frozen=True)
class Pilot:
    state: str
    client_agency: str
    pilot: str
    start_date: dt.date
    end_date: dt.date


@dataclass(frozen=True)
class Params:
    """Parameters of one report run.

    ``as_of`` replaces the wall clock ("today") in the trend and in the
    extraction and lookback windows; when ``None`` the latest event date in the
    data is used, so a rerun on the same data gives the same tables.
    """

    agency: str = "tst"
    report_type: str = "month"  # "month" or "week"
    as_of: dt.date | None = None
    pilots: tuple[Pilot, ...] = ()
    key_events: tuple[str, ...] = KEY_EVENTS
    event_dictionary: tuple[tuple[str, str], ...] = EVENT_DICTIONARY
    mask_seed: str = "42"
    mask_share: float = 0.6
    mask_days: int = 180
    mask_years: int = 24
    mask_state: str = "North Grouchland"
    top_n: int = 10
    # Opt-in sketches instead of exact distinct counts / quantiles (one pass,
    # bounded memory); off by default so results match the reference exactly.
    approx: bool = False
    approx_accuracy: int = 10_000      # percentile_approx accuracy
    approx_rsd: float = 0.05           # approx_count_distinct relative standard error

    def with_(self, **kw) -> "Params":
        from dataclasses import replace

        return replace(self, **kw)


# Agency and pilot calendar of the test data's programme (see FIXTURES.md §4).
TEST_AGENCY = "tst"
TEST_PILOTS: tuple[Pilot, ...] = (
    Pilot("Testland", "tst", "Pilot A", dt.date(2024, 1, 1), dt.date(2024, 1, 14)),
    Pilot("Testland", "tst", "Pilot B", dt.date(2024, 1, 16), dt.date(2024, 1, 29)),
)


def dict_name(dictionary: tuple[tuple[str, str], ...], event: str) -> str | None:
    """Readable name of ``event`` in an event dictionary."""
    return dict(dictionary).get(event)
