"""Wide staged water rows, one set per kind of identifier."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators.joins import lookup
from ..operators.shape import canonical, ensure_columns, first_useful, keep_usable_key, upper_names
from ..schemas import column_of, find_field

# Names a join column may have.
ALIASES: Mapping[str, tuple[str, ...]] = {
    "VFCTRACKING_NUMBER": (
        "VFCTRACKING_NUMBER", "VFCTRACKINGNUMBER", "VFC_TRACKING_NUMBER", "VFC_TRACKINGNUMBER", "TRACKINGNUMBER",
    ),
    "ATSLINKID": ("ATSLINKID", "ATS_LINK_ID", "ATS_LINKID"),
    "ATSAUTHORIZATIONNUMBER": ("ATSAUTHORIZATIONNUMBER", "ATS_AUTHORIZATION_NUMBER", "ATSAUTHNUMBER"),
    "AUTHORIZATION_ID": ("AUTHORIZATION_ID", "AUTHORIZATIONID"),
}

# Columns the rules expect and where each may come from if it is absent.
EXPECTED_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "CREATEDDATE": ("CREATEDDATE",),
    "SUBMITTEDDATE": ("SUBMITTEDDATE",),
    "APPLICATION_ACCEPTED_DATE": ("APPLICATION_ACCEPTED_DATE", "FCBCACCEPTEDDATE", "RECEIVEDDATE"),
    "APPLICATION_RECEIVED_DATE": ("APPLICATION_RECEIVED_DATE", "RECEIVEDDATE"),
    "APPLICATION_REJECTED_DATE": ("APPLICATION_REJECTED_DATE",),
    "AUTHORIZATION_STATUS_CODE": ("AUTHORIZATION_STATUS_CODE",),
    "ATHN_CLOSE_REASON_CODE": ("ATHN_CLOSE_REASON_CODE",),
    "ADJUDICATION_DATE": ("ADJUDICATION_DATE", "GRANTEDREFUSEDATE", "ATSDECISIONDATE"),
    "FIRST_NATION_START_DATE": ("FIRST_NATION_START_DATE",),
    "FIRST_NATION_COMPLETION_DATE": ("FIRST_NATION_COMPLETION_DATE",),
    "ADJUDICATED_DAT": ("ADJUDICATED_DAT", "ADJUDICATION_DATE"),
    "LAND_STATUS_DAT": ("LAND_STATUS_DAT", "TECH_REVIEW_COMPLETION_DATE", "TECHASSESSMENTCOMPLETEDATE"),
    "REPORTED_DAT": ("REPORTED_DAT", "FCBC_PROCESS_COMPLETE_DATE", "FCBCCOMPLETEDATE", "GRANTEDREFUSEDATE"),
    "DISALLOWED_DAT": ("DISALLOWED_DAT", "APPLICATION_REJECTED_DATE"),
    "OFFERED_DAT": ("OFFERED_DAT",),
    "OFFER_NOT_ACCEPTED_DAT": ("OFFER_NOT_ACCEPTED_DAT",),
    "COMMENCEMENT_DAT": ("COMMENCEMENT_DAT",),
    "CANCELED_DAT": ("CANCELED_DAT",),
    "EXPIRY_DAT": ("EXPIRY_DAT", "AUTHORIZATION_DUE_DATE"),
    "CODE_CHR_STATUS": (),
}
GUARD_COLUMNS = ("CODE_CHR_STATUS != 'CA'", "CODE_CHR_STATUS != 'DI'")
APPLICATION_SUFFIX, LINK_SUFFIX, AUTHORIZATION_SUFFIX = "__APP", "__ATSNO", "__AUTH"

JOB, TRACKING, AUTHORIZATION = "job", "tracking", "authorization"
_ANY = "*"
_TRACK_KEY, _LINK_KEY, _AUTH_KEY, _LINK_AUTH = "__track_key", "__link_key", "__auth_key", "__link_auth"


@dataclass(frozen=True)
class WaterTables:
    """Water jobs, applications, link numbers and authorizations."""

    jobs: DataFrame
    applications: DataFrame
    links: DataFrame
    authorizations: DataFrame

    def normalised(self) -> WaterTables:
        """Upper-case names, join columns under their canonical names."""
        return WaterTables(
            _canonical(self.jobs, "jobs", "VFCTRACKING_NUMBER", "AUTHORIZATION_ID"),
            _canonical(self.applications, "applications", "VFCTRACKING_NUMBER", "ATSLINKID"),
            _canonical(self.links, "links", "ATSLINKID", "ATSAUTHORIZATIONNUMBER"),
            _canonical(self.authorizations, "authorizations", "AUTHORIZATION_ID"),
        )


def _canonical(df: DataFrame, table: str, *names: str) -> DataFrame:
    df = upper_names(df)
    for name in names:
        df = canonical(df, name, ALIASES[name], table)
    return df


def water_staging(tables: WaterTables, route: str, id_column: str, corrected: bool = False,
                  null_match: bool = False) -> DataFrame:
    """Staged rows of one route: by job number; without one, by tracking number; with neither,
    by authorization number.

    The corrected form trusts a job's own authorization: its link rows must carry it too. Link
    and application rows are not deduplicated, so a job with several of them gives several rows.
    """
    t = tables.normalised()
    jobs = t.jobs.filter(_route_filter(t.jobs, route))
    rows = _with_applications(jobs, t.applications, null_match)
    rows = (_with_trusted_links if corrected else _with_links)(rows, t.links, null_match)
    rows = _with_authorizations(rows, t.authorizations, null_match)
    rows = rows.withColumn(id_column, _route_id(rows, route))
    rows = ensure_columns(keep_usable_key(rows, id_column), EXPECTED_COLUMNS)
    return _with_guards(rows)


def _blank(df: DataFrame, name: str) -> Column:
    return text.is_blank(*column_of(df, name))


def _route_filter(jobs: DataFrame, route: str) -> Column:
    """The part of the routing that a job's own columns decide; it runs before any join."""
    no_job, no_tracking = _blank(jobs, "JOBNUMBER"), _blank(jobs, "VFCTRACKING_NUMBER")
    return {JOB: ~no_job, TRACKING: no_job & ~no_tracking, AUTHORIZATION: no_job & no_tracking}[route]


def _authorization_number(rows: DataFrame) -> tuple[Column, object]:
    names = ("ATSAUTHORIZATIONNUMBER", "ATSAUTHORIZATIONNUMBER" + LINK_SUFFIX)
    value = first_useful(rows, names)
    return value, rows.select(value.alias("v")).schema["v"].dataType


def _route_id(rows: DataFrame, route: str) -> Column:
    if route == AUTHORIZATION:
        return text.plain_text(*_authorization_number(rows))
    return text.plain_text(*column_of(rows, "JOBNUMBER" if route == JOB else "VFCTRACKING_NUMBER"))


def _with_applications(jobs: DataFrame, applications: DataFrame, null_match: bool) -> DataFrame:
    name = "VFCTRACKING_NUMBER"
    return lookup(
        jobs.withColumn(_TRACK_KEY, text.key_text(*column_of(jobs, name))),
        applications.withColumn(_TRACK_KEY, text.key_text(*column_of(applications, name))),
        [(_TRACK_KEY, _TRACK_KEY)],
        columns=applications.columns, suffix=APPLICATION_SUFFIX, null_match=null_match,
    ).drop(_TRACK_KEY)


def _link_key(rows: DataFrame) -> Column:
    value = first_useful(rows, ("ATSLINKID", "ATSLINKID" + APPLICATION_SUFFIX))
    return text.key_text(value, rows.select(value.alias("v")).schema["v"].dataType)


def _with_links(rows: DataFrame, links: DataFrame, null_match: bool) -> DataFrame:
    return lookup(
        rows.withColumn(_LINK_KEY, _link_key(rows)),
        links.withColumn(_LINK_KEY, text.key_text(*column_of(links, "ATSLINKID"))),
        [(_LINK_KEY, _LINK_KEY)],
        columns=links.columns, suffix=LINK_SUFFIX, null_match=null_match,
    ).drop(_LINK_KEY)


def _with_trusted_links(rows: DataFrame, links: DataFrame, null_match: bool) -> DataFrame:
    """Link rows by link id and authorization where the job has one, by link id alone where not.

    Both cases share one join: each link row is offered under its own authorization and under a
    wildcard. Only the small link table doubles; jobs and applications are read and joined once.
    """
    own = numbers.number_key(*column_of(rows, "AUTHORIZATION_ID"))
    theirs = numbers.number_key(*column_of(links, "ATSAUTHORIZATIONNUMBER"))
    offered = links.withColumn(_LINK_KEY, text.key_text(*column_of(links, "ATSLINKID"))).withColumn(
        _LINK_AUTH, F.explode(F.array(theirs, F.lit(_ANY)))
    )
    return lookup(
        rows.withColumns({_LINK_KEY: _link_key(rows), _LINK_AUTH: F.coalesce(own, F.lit(_ANY))}),
        offered,
        [(_LINK_KEY, _LINK_KEY), (_LINK_AUTH, _LINK_AUTH)],
        columns=links.columns, suffix=LINK_SUFFIX, null_match=null_match,
    ).drop(_LINK_KEY, _LINK_AUTH)


def _with_authorizations(rows: DataFrame, authorizations: DataFrame, null_match: bool) -> DataFrame:
    """Authorization by the job's own id if it is a number, else by the linked number."""
    own = numbers.number_key(*column_of(rows, "AUTHORIZATION_ID"))
    keyed = authorizations.withColumn(
        "AUTHORIZATION_ID", numbers.number_key(*column_of(authorizations, "AUTHORIZATION_ID"))
    )
    return lookup(
        rows.withColumn(_AUTH_KEY, F.coalesce(own, numbers.number_key(*_authorization_number(rows)))),
        keyed,
        [(_AUTH_KEY, "AUTHORIZATION_ID")],
        columns=keyed.columns, suffix=AUTHORIZATION_SUFFIX, null_match=null_match,
    ).drop(_AUTH_KEY)


def _with_guards(rows: DataFrame) -> DataFrame:
    status = first_useful(rows, ("CODE_CHR_STATUS",))
    dtype = column_of(rows, "CODE_CHR_STATUS")[1]
    return rows.withColumns({
        name: text.status_guard(status, dtype)
        for name in GUARD_COLUMNS if find_field(rows.schema, name) is None
    })
