"""Column names, layouts, filters, routing and appending."""

from pyspark.sql import functions as F

from casetrail.functions import text
from casetrail.operators import routing, shape
from casetrail.operators.joins import lookup
from casetrail.operators.shape import convert_types, ensure_columns, fixed_layout, typed_nulls
from casetrail.plans.dispositions import counted_transactions, current_statuses, land_applications
from casetrail.schemas import column_of
from casetrail.sources.replicate import ReplicaSpec, landed
from casetrail.sources.sharing import ShareSpec, shared_rows
from casetrail.sources.split import key_bounds, number_predicates, range_predicates, split_report

from . import shapes
from .registry import query, with_shapes


@query(with_shapes(
    """SELECT VfcTrackingNumber AS VFCTRACKINGNUMBER, VfcTrackingNumber AS VFCTRACKING_NUMBER,
        ReceivedDate AS RECEIVEDDATE, FcbcAcceptedDate AS FCBCACCEPTEDDATE,
        coalesce(FcbcAcceptedDate, ReceivedDate) AS APPLICATION_ACCEPTED_DATE,
        CASE WHEN trim(Code_Chr_Status) = '' THEN 'OK' WHEN Code_Chr_Status = '10:30' THEN 'OK'
             ELSE Code_Chr_Status END AS "CODE_CHR_STATUS != 'CA'"
    FROM jobs""", jobs=shapes.WATER_JOBS))
def canonical_columns(t):
    jobs = t.shape(shapes.WATER_JOBS).withColumnRenamed("ReceivedDate", " ReceivedDate ")
    named = shape.canonical(
        shape.upper_names(jobs), "VFCTRACKING_NUMBER", ["VFC_TRACKING", "VFCTRACKINGNUMBER"], "jobs"
    )
    filled = ensure_columns(named, {
        "APPLICATION_ACCEPTED_DATE": ("FCBCACCEPTEDDATE", "RECEIVEDDATE"),
        "RECEIVEDDATE": ("GRANTEDREFUSEDATE",),
    })
    guard = text.status_guard(shape.first_useful(filled, ["CODE_CHR_STATUS"]))
    return filled.withColumn("CODE_CHR_STATUS != 'CA'", guard).drop(
        "JOBNUMBER", "ATSLINKID", "AUTHORIZATIONID", "FCBCCOMPLETEDATE", "GRANTEDREFUSEDATE",
        "CODE_CHR_STATUS", "__HELPER_THAT_IS_NOT_THERE",
    )


@query(with_shapes(
    """SELECT TRY_CAST(trim(TRACKINGNUMBER) AS BIGINT) AS tracking_as_number,
        CAST(JOBID AS VARCHAR) AS JOBID, 'ITSM-6072' AS system_id,
        CAST(NULL AS VARCHAR) AS STAGE_NME, CAST(NULL AS BIGINT) AS DISPOSITION_SID,
        TRACKINGNUMBER AS PERMIT_ID, CREATEDDATE
    FROM applications""", applications=shapes.APPLICATIONS))
def fixed_types_and_layout(t):
    applications = t.shape(shapes.APPLICATIONS)
    wide = typed_nulls(applications, {"STAGE_NME": "string", "DISPOSITION_SID": "bigint"}).withColumns({
        "system_id": F.lit("ITSM-6072"),
        "PERMIT_ID": F.col("TRACKINGNUMBER").cast("string"),
        "tracking_as_number": F.col("TRACKINGNUMBER"),
    })
    chosen = fixed_layout(wide, [
        "tracking_as_number", "JOBID", "system_id", "STAGE_NME", "DISPOSITION_SID", "PERMIT_ID", "CREATEDDATE",
    ])
    return convert_types(chosen, {
        "tracking_as_number": "bigint", "JOBID": "string", "CREATEDDATE": "timestamp_ntz", "PERMIT_ID": "string",
    })


CUSTOMERS = "SELECT c_custkey AS ID, c_name AS NAME, c_nationkey AS NATION FROM {customer}"
NATIONS = "SELECT n_nationkey AS ID, n_name AS NAME, n_regionkey AS REGION FROM {nation}"


@query(with_shapes(
    """SELECT c.ID, c.NAME, c.NATION, n.ID AS ID__APP, n.NAME AS NAME__APP, n.REGION
    FROM customers c LEFT JOIN nations n ON n.ID = c.NATION""", customers=CUSTOMERS, nations=NATIONS))
def suffix_on_clash(t):
    nations = t.shape(NATIONS)
    return lookup(t.shape(CUSTOMERS), nations, [("NATION", "ID")], columns=nations.columns, suffix="__APP")


@query(with_shapes(
    """SELECT c.ID, c.NAME, c.NATION, n.NAME AS ATS_NAME, n.REGION
    FROM customers c LEFT JOIN nations n ON n.ID = c.NATION""", customers=CUSTOMERS, nations=NATIONS))
def prefix_on_clash(t):
    return lookup(t.shape(CUSTOMERS), t.shape(NATIONS), [("NATION", "ID")], columns=["NAME", "REGION"], prefix="ATS_")


@query(with_shapes(
    """SELECT DISPOSITION_TRANSACTION_SID, TYPE_SID, SUBTYPE_SID, RECEIVED_DAT FROM tx
    WHERE CAST(RECEIVED_DAT AS DATE) >= DATE '2014-04-01' AND APPLICATION_TYPE_CDE = 'NEW'
      AND TYPE_SID <> 51 AND NOT (TYPE_SID = 1 AND SUBTYPE_SID = 101)""", tx=shapes.TRANSACTIONS))
def counted_transaction_rows(t):
    return counted_transactions(t.shape(shapes.TRANSACTIONS)).select(
        "DISPOSITION_TRANSACTION_SID", "TYPE_SID", "SUBTYPE_SID", "RECEIVED_DAT"
    )


@query(with_shapes(
    """SELECT a.TRACKINGNUMBER, a.BUSINESSAREA FROM applications a
    WHERE BUSINESSAREA = 'Crown Land Adjudication (vFCBC)' AND TRACKINGNUMBER IS NOT NULL
      AND trim(TRACKINGNUMBER) <> ''""", applications=shapes.APPLICATIONS))
def usable_land_applications(t):
    kept = shape.keep_usable_key(land_applications(t.shape(shapes.APPLICATIONS)), "TRACKINGNUMBER")
    return kept.select("TRACKINGNUMBER", "BUSINESSAREA")


@query(with_shapes(
    """SELECT DISPOSITION_TRANSACTION_SID, CODE_CHR_STATUS, EFFECTIVE_DAT FROM st
    WHERE EXPIRY_DAT IS NULL""", st=shapes.STATUSES))
def current_status_rows(t):
    return current_statuses(t.shape(shapes.STATUSES)).select(
        "DISPOSITION_TRANSACTION_SID", "CODE_CHR_STATUS", "EFFECTIVE_DAT"
    )


@query(with_shapes(
    """SELECT PERMIT_ID, 'early' AS half, FEE, CAST(NULL AS VARCHAR) AS PRIORITY FROM permits
       WHERE RECEIVED < DATE '1998-01-01'
    UNION ALL
    SELECT PERMIT_ID, 'late' AS half, CAST(NULL AS DOUBLE) AS FEE, PRIORITY FROM permits
       WHERE NOT coalesce(RECEIVED < DATE '1998-01-01', false)""", permits=shapes.PERMITS))
def split_and_append(t):
    early, late = routing.split(t.shape(shapes.PERMITS), F.col("RECEIVED") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return routing.append(
        early.select("PERMIT_ID", F.lit("early").alias("half"), "FEE"),
        late.select("PERMIT_ID", F.lit("late").alias("half"), "PRIORITY"),
    )


@query(with_shapes(
    """SELECT AuthorizationId AS raw_id,
        CASE WHEN trim(JobNumber) <> '' THEN JobNumber WHEN trim(VfcTrackingNumber) <> '' THEN VfcTrackingNumber
             ELSE CAST(CAST(AuthorizationId AS BIGINT) AS VARCHAR) END AS PERMIT_ID,
        CASE WHEN trim(JobNumber) <> '' THEN 'job' WHEN trim(VfcTrackingNumber) <> '' THEN 'tracking'
             ELSE 'authorization' END AS id_kind
    FROM jobs WHERE trim(JobNumber) <> '' OR trim(VfcTrackingNumber) <> '' OR AuthorizationId IS NOT NULL""",
    jobs=shapes.WATER_JOBS).replace("AuthorizationId AS raw_id", "CAST(AuthorizationId AS BIGINT) AS raw_id"))
def identifier_routes(t):
    jobs = t.shape(shapes.WATER_JOBS)
    columns = {
        name: column_of(jobs, c)
        for name, c in (("job", "JobNumber"), ("tracking", "VfcTrackingNumber"), ("authorization", "AuthorizationId"))
    }
    routed = routing.route(
        jobs, [(n, text.is_blank(*c), text.plain_text(*c)) for n, c in columns.items()], "PERMIT_ID"
    )
    return routed.select(F.col("AuthorizationId").cast("bigint").alias("raw_id"), "PERMIT_ID", "id_kind")


PEOPLE = """
SELECT c_custkey AS PERSON_ID, c_name AS LAST_NAME, c_acctbal AS BALANCE, c_mktsegment AS COMPANY_NAME,
       TIMESTAMP_NTZ '1900-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 3) AS WHEN_CREATED
FROM {customer}"""


@query("""SELECT c_custkey AS PERSON_ID, c_mktsegment AS COMPANY_NAME,
    CASE WHEN c_custkey % 3 = 0 THEN NULL
         ELSE TIMESTAMP '1900-01-01 00:00:00' + to_days(CAST(c_custkey % 3 AS INTEGER)) END AS WHEN_CREATED
    FROM customer""")
def redacted_rows(t):
    people = t.shape(PEOPLE)
    spec = ShareSpec("people_redacted", "people", ("PERSON_ID", "COMPANY_NAME", "WHEN_CREATED"), ("WHEN_CREATED",))
    return shared_rows(people, spec)


@query("""SELECT event_id AS PROCESSID, ts AS CREATEDDATE, event_type AS PROCESSNAME FROM events
    WHERE event_type IN ('error', 'signup')""")
def shared_process_rows(t):
    processes = t.table("events").select(
        F.col("event_id").alias("PROCESSID"), F.col("ts").alias("CREATEDDATE"),
        F.col("event_type").alias("PROCESSNAME"), "props", "user_id",
    )
    return shared_rows(processes, ShareSpec(
        "processes_subset", "processes", ("PROCESSID", "CREATEDDATE", "PROCESSNAME"), ("CREATEDDATE",),
        ("PROCESSNAME", ("error", "signup")),
    ))


@query(r"""SELECT p_partkey AS PART_ID, CAST(trunc(p_retailprice) AS INTEGER) AS PRICE,
    CAST(p_size AS BIGINT) AS SIZE_NO, CAST(NULL AS INTEGER) AS BRAND_NO, p_type AS KIND
    FROM part""")
def landed_columns(t):
    spec = ReplicaSpec("src", "PARTS", "raw", "parts", (
        ("P_PARTKEY", "PART_ID", "bigint"), ("P_RETAILPRICE", "PRICE", "int"), ("P_SIZE", "SIZE_NO", "bigint"),
        ("P_BRAND", "BRAND_NO", "int"), ("P_TYPE", "KIND", "string"),
    ))
    return landed(t.table("part"), spec)


# Keys whose distances grow, as keys of a system that was filled by several migrations.
UNEVEN_KEYS = "SELECT CASE WHEN o_orderkey % 501 = 0 THEN NULL ELSE o_orderkey * o_orderkey END AS k, 'A' || CAST(o_orderkey AS STRING) AS t FROM {orders}"


@query("""SELECT how, CAST(pieces AS BIGINT) AS pieces, (SELECT count(*) FROM orders) AS rows,
        (SELECT count(*) FROM orders) AS rows_taken_once, true AS within_twice
    FROM (VALUES ('range of a number', 64), ('range of a time', 32), ('number of a text', 8)) v(how, pieces)""")
def split_by_keys(t):
    """Pieces for parallel reading, by quantiles of the keys and by key numbers: every row once, sizes within twice."""
    keyed, orders = t.shape(UNEVEN_KEYS), t.table("orders")
    reports = {
        "range of a number": split_report(keyed, range_predicates("k", key_bounds(keyed, "k", 64))),
        "range of a time": split_report(orders, range_predicates("o_orderdate", key_bounds(orders, "o_orderdate", 32))),
        "number of a text": split_report(keyed, number_predicates("t", 8, "spark")),
    }
    told = [
        r.select(F.lit(how).alias("how"), "pieces", "rows", "rows_taken_once", (F.col("most") < 2 * F.col("fewest")).alias("within_twice"))
        for how, r in reports.items()
    ]
    return told[0].unionAll(told[1]).unionAll(told[2])
