"""Report parameters.

The reference hard-codes its clock (CURRENT_DATE), date floors, account ids and an
environment prefix inside the SQL text. Here they are one frozen object that every
report builder receives, so a run is reproducible and a test can pin the clock.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass, field

D = dt.date


@dataclass(frozen=True)
class ReportConfig:
    # environment prefix of the lineage labels; built in Python, never
    # substituted by spark.sql, which would silently blank an unset variable
    env: str
    # "today" of the run; every CURRENT_DATE of the reference reads this
    as_of: D
    # floor of the channel views (sea, display, social)
    min_date: D
    # legacy bing keyword load: closed date range
    legacy_from: D
    legacy_to: D
    # floor of the branding view and first year of out-of-home rows
    branding_min_date: D
    # first day of the branding calendar (the calendar itself is rewritten away)
    branding_calendar_start: D
    # generated calendar for the affiliate fix-cost spread
    fixcost_calendar_start: D
    fixcost_calendar_end: D
    # affiliate look-back in years
    affiliate_years: int = 2
    # display accounts
    google_ace_account: int = 0
    gdn_account: int = 0
    bing_audience_account: int = 0
    odin_excluded_customers: tuple[int, ...] = ()
    # social accounts
    facebook_excluded_accounts: tuple[int, ...] = ()
    youtube_accounts: tuple[int, ...] = ()
    tiktok_app_install_account: int = 0
    tiktok_static_account: int = 0
    tiktok_dynamic_account: int = 0
    # in-house branding accounts
    odin_branding_customer: int = 0
    facebook_branding_account: int = 0
    snap_branding_account_name: str = ""
    youtube_branding_accounts: tuple[int, ...] = ()
    tiktok_branding_account: int = 0
    # lineage labels by logical source name, where they differ from it
    labels: dict[str, str] = field(default_factory=dict, compare=False)

    @property
    def yesterday(self) -> D:
        return self.as_of - dt.timedelta(days=1)

    @property
    def affiliate_from(self) -> D:
        """ADD_YEARS(CURRENT_DATE, -n): same day n years back, Feb 29 -> Feb 28."""
        y = self.as_of.year - self.affiliate_years
        try:
            return self.as_of.replace(year=y)
        except ValueError:
            return self.as_of.replace(year=y, day=28)

    @property
    def dooh_min_year(self) -> int:
        return self.branding_min_date.year

    def with_(self, **kw) -> "ReportConfig":
        return dataclasses.replace(self, **kw)


def production(env: str, as_of: D, snap_branding_account_name: str, accounts: dict,
               labels: dict[str, str] | None = None) -> ReportConfig:
    """Date floors and windows of the reports; whose accounts they are is the caller's.

    ``accounts`` holds the account fields of ``ReportConfig`` by name, ``labels`` the
    lineage labels. The snap branding account is selected by its (lower-cased) name.
    """
    return ReportConfig(
        env=env,
        as_of=as_of,
        min_date=D(2020, 1, 1),
        legacy_from=D(2020, 1, 1),
        legacy_to=D(2020, 6, 30),
        branding_min_date=D(2021, 1, 1),
        branding_calendar_start=D(2020, 1, 1),
        fixcost_calendar_start=D(2017, 1, 1),
        fixcost_calendar_end=D(2049, 1, 1),
        snap_branding_account_name=snap_branding_account_name.lower(),
        labels=labels or {},
        **accounts,
    )


def testing() -> ReportConfig:
    """Clock and ids for the fixture bindings over /root/testdata.

    The fixture facts run 1995..2001, so every date is moved back by the same
    offset as the data: min_date 1996 plays 2020, branding floor 1997 plays 2021.
    Account ids are the small ids that the bindings generate.
    """
    return ReportConfig(
        env="TEST",
        as_of=D(2001, 6, 30),
        min_date=D(1996, 1, 1),
        legacy_from=D(1996, 1, 1),
        legacy_to=D(1996, 6, 30),
        branding_min_date=D(1997, 1, 1),
        branding_calendar_start=D(1996, 1, 1),
        fixcost_calendar_start=D(1993, 1, 1),
        fixcost_calendar_end=D(2025, 1, 1),
        google_ace_account=100,
        gdn_account=101,
        bing_audience_account=102,
        odin_excluded_customers=(2, 4),
        facebook_excluded_accounts=(103,),
        youtube_accounts=(100, 104),
        tiktok_app_install_account=101,
        tiktok_static_account=102,
        tiktok_dynamic_account=103,
        odin_branding_customer=4,
        facebook_branding_account=103,
        snap_branding_account_name="acct 101",
        youtube_branding_accounts=(102, 100),
        tiktok_branding_account=104,
    )
