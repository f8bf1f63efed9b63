"""The queries of this repository and, for each, the SQL that gives the same result.

``queries()`` runs on a folder of the given tables; ``oracle_sql()`` holds the SQL for the
same key on the same tables. Moments are fixed, so results do not depend on the day.
"""

from __future__ import annotations

import functools
import pathlib
import sys
from collections.abc import Callable
from datetime import datetime, timedelta

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import recipes  # noqa: E402
from dustline import (  # noqa: E402
    UsageState,
    access_history,
    all_object_mentions,
    all_sheets,
    append_arrivals,
    append_folder,
    check_table,
    combine_sheets,
    combine_workbook,
    data_check,
    data_check_all,
    dim_access_history,
    export_csv,
    first_sheet,
    flatten_access_history,
    identifier_mentions,
    ingest_folder,
    ingest_workbooks,
    materialize,
    mention_index,
    object_mentions,
    object_usage,
    positional_load,
    read_csv_text,
    read_tables,
    save_as_text,
    scan_workbooks,
    sheet_rows,
    stale_rows,
    unused_objects,
)
from dustline.functions.names import table_name  # noqa: E402
from dustline.functions.text import NULL_TOKENS, csv_line  # noqa: E402
from dustline.operators.text_tables import RAW  # noqa: E402
from dustline.plans.append import LOAD, AppendTable  # noqa: E402
from dustline.sources.shared import new_folder, staged  # noqa: E402
from dustline.streaming.arrivals import Arrivals  # noqa: E402

try:
    import corpus_pipeline
    from dustline.llm import oracles as corpus_oracles
    from dustline.llm import queries as corpus_queries
except ImportError as problem:  # the operators on a corpus can be left out, as a whole
    if problem.name not in ("corpus_pipeline", "dustline.llm"):
        raise
    corpus_pipeline = None

USAGE_AS_OF = datetime(2024, 4, 20, 12)
CHECK_AS_OF = datetime(1998, 1, 1)
CHECK_INTERVAL = timedelta(days=90)
PARTS = ["p_partkey", "p_name", "p_brand", "p_type"]

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Pairs of object and user without a change for 90 days."""
    return queries()["unused_objects"](spark, "/root/testdata/sf0.001")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_history(recipes.derived(spark, sf_dir, recipes.HISTORY_SQL))


def _query_log(spark: SparkSession, sf_dir: str, schema: str = "DB.SALES") -> DataFrame:
    return recipes.derived(spark, sf_dir, recipes.QUERY_LOG_SQL.format(schema))


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.derived(spark, sf_dir, recipes.AUDITED_SQL)


def _unused(multiplicity: str) -> Query:
    return lambda spark, sf_dir: unused_objects(
        _history(spark, sf_dir), USAGE_AS_OF, 90, multiplicity
    )


def _unused_objects_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from a state that read three arrivals one by one, each with rows of all times."""
    history = _history(spark, sf_dir)
    arrival = F.date_add(F.lit("2024-04-18").cast("date"), (F.col("QUERY_ID").cast("long") % 3).cast("int"))
    history = staged(history.withColumn("arrived", arrival), "history", ["arrived"])
    state = UsageState(spark, new_folder(spark, "usage-state"))
    for day in ("2024-04-18", "2024-04-19", "2024-04-20"):
        state.catch_up(history.where(F.col("arrived") <= F.lit(day).cast("date")), "arrived")
    state.catch_up(history, "arrived")  # finds nothing new
    return state.unused_objects(USAGE_AS_OF, 90)


def _dim_access_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = dim_access_history(_history(spark, sf_dir))
    return materialize(model, "dim_access_history", database=recipes.run_database(spark))


def _data_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, target = _query_log(spark, sf_dir), _audited(spark, sf_dir)
    return data_check(log, target, "db.sales.click", CHECK_INTERVAL, CHECK_AS_OF)


def _check_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = recipes.run_database(spark)
    materialize(_audited(spark, sf_dir), "click", database=database)
    log = _query_log(spark, sf_dir, f"SPARK_CATALOG.{database}")
    return check_table(
        spark, log, "spark_catalog", database, "click", CHECK_INTERVAL, CHECK_AS_OF
    )


#: Names that query texts of QUERIES_SQL mention or not; some are parts of others, or patterns.
NAMES = [
    "db.sales.click", "DB.Sales.CLICK2", "sales.click", "sales", "db_sales", "d%s.purchase", "db.sales.view",
    "DB.SALES.SIGNUP", "db.sales.error", "error", "not.there", "orders", "100%", "u=1",
]
NAMES += [f"u={i}" for i in range(100)] + [f"u={i}9" for i in range(100)]
#: Queries that name their object in every way, and some that do so in strings and comments only.
QUERIES_SQL = """
    SELECT CASE event_id % 8
               WHEN 0 THEN concat('select * from DB.SALES.', upper(event_type))
               WHEN 1 THEN concat('select * from ', event_type, ' /* not db.sales.', event_type, '2 */')
               WHEN 2 THEN concat('SELECT x.* FROM Sales . ', event_type, ' x')
               WHEN 3 THEN concat('select * from db.sales.', event_type, '2')
               WHEN 4 THEN concat('select ''db.sales.', event_type, chr(39), ' /* from ', event_type, ' */')
               WHEN 5 THEN concat('select * from "DB"."SALES"."', event_type, '"')
               WHEN 6 THEN concat('select other.', event_type, '.b from db.sales.', event_type)
           END || ' where u=' || CAST(user_id AS STRING) AS query_text,
           ts AS end_time
    FROM events
"""
AUDITED = {"click": "F", "purchase": "O", "error": "P", "view": "none"}


def _all_object_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_object_mentions(recipes.derived(spark, sf_dir, QUERIES_SQL), NAMES)


def _check_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events as tables of orders of one status; one of them has no row."""
    audited = recipes.given(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("last_accessed_timestamp"), "o_orderstatus"
    )
    targets = {
        f"db.sales.{kind}": audited.where(F.col("o_orderstatus") == status)
        for kind, status in AUDITED.items()
    }
    log = recipes.derived(spark, sf_dir, QUERIES_SQL)
    return data_check_all(log, targets, CHECK_INTERVAL, CHECK_AS_OF)


def _identifier_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = recipes.given(spark, sf_dir, "events").select("event_type").distinct()
    upper = F.upper("event_type")
    each = F.explode(F.array(upper, F.concat(upper, F.lit("2")), F.col("event_type")))
    objects = kinds.select(F.lit("DB").alias("object_database"), each.alias("object_name")).select(
        "*", F.explode(F.array(F.lit("SALES"), F.lit("OTHER"))).alias("object_schema")
    )
    log = recipes.derived(spark, sf_dir, QUERIES_SQL)
    return identifier_mentions(mention_index(log, "DB", "SALES"), objects)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with commas, quotes and line breaks under names that need cleaning."""
    return recipes.given(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc id (#)"),
        F.col("text").alias("Text/Body"),
        F.col("lang").alias("2-letter lang"),
        F.col("source"),
        F.col("n_chars").alias("Größe"),
    )


def _csv_ingest(split_bytes: int | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = recipes.csv_folder(spark, {"2024 docs.csv": _documents(spark, sf_dir)})
        database = recipes.run_database(spark)
        ingest_folder(spark, folder, database, split_bytes=split_bytes)
        return spark.table(f"{database}._2024_docs")

    return run


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = recipes.given(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    path = new_folder(spark, "export")
    export_csv(orders, path)
    export_csv(orders, path)  # replaces the first export
    return read_csv_text(spark, path, null_tokens=[]).drop(RAW)


#: Tables by the file they come from, with three columns that read alike as text anywhere.
EXPORTS = {
    "2024 events-log.csv": ("events", ["event_id", "user_id", "event_type"]),
    "customer (main).csv": ("customer", ["c_custkey", "c_name", "c_mktsegment"]),
    "docs.v1.csv.csv": ("documents", ["doc_id", "text", "lang"]),
    "line items.csv": ("lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"]),
    "orders.csv": ("orders", ["o_orderkey", "o_custkey", "o_orderpriority"]),
}


def _csv_folder_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all loaded tables."""
    folder = recipes.csv_folder(
        spark,
        {name: recipes.given(spark, sf_dir, table) for name, (table, _) in EXPORTS.items()},
    )
    database = recipes.run_database(spark)
    status = ingest_folder(spark, folder, database).where("error IS NULL").collect()
    columns = {table_name(name): columns for name, (_, columns) in EXPORTS.items()}
    loaded = [
        spark.table(f"{database}.{row['table']}").select(
            F.lit(row["table"]).alias("table"),
            F.lit(row["rows"]).alias("rows"),
            *[F.col(name).alias(f"column_{i}") for i, name in enumerate(columns[row["table"]])],
        )
        for row in status
    ]
    return functools.reduce(DataFrame.unionByName, loaded)


#: Cells of two tables that inference spells anew, or leaves alone for the others in their column.
TYPED = {
    "lineitem": {
        "code": "lpad(CAST(l_orderkey AS STRING), 12, '0')",
        "with gaps": "CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS STRING) END",
        "mixed": """CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity AS INT) AS STRING)
            ELSE CAST(l_quantity AS STRING) END""",
        "small": "concat(CAST(l_extendedprice AS STRING), 'e-9')",
        "truth": "CASE l_returnflag WHEN 'R' THEN 'TRUE' WHEN 'A' THEN 'false' ELSE 'NA' END",
        "text": "CASE WHEN l_linestatus = 'O' THEN concat('0', CAST(l_linenumber AS STRING)) ELSE 'n/a ' END",
    },
    "part": {
        "code": "CAST(CAST(9223372036854775800 AS DECIMAL(20, 0)) + p_partkey AS STRING)",
        "with gaps": "CASE WHEN p_size > 1 THEN concat(' +', CAST(p_size AS STRING), ' ') END",
        "mixed": "CASE WHEN p_size > 25 THEN 'true' ELSE CAST(p_size AS STRING) END",
        "small": "concat(CAST(p_retailprice AS STRING), 'E13')",
        "truth": "CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'fALSE' END",
        "text": "CASE WHEN p_size = 2 THEN '99999999999999999999' ELSE CAST(-p_size AS STRING) END",
    },
}


def _csv_inferred_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns have types that change how cells are spelled."""
    exports = {
        f"{name}.csv": recipes.given(spark, sf_dir, name).select(
            *[F.expr(cell).alias(column) for column, cell in cells.items()]
        )
        for name, cells in TYPED.items()
    }
    database = recipes.run_database(spark)
    ingest_folder(spark, recipes.csv_folder(spark, exports), database, infer=True)
    loaded = [spark.table(f"{database}.{name}").withColumn("table", F.lit(name)) for name in TYPED]
    return functools.reduce(DataFrame.unionByName, loaded)


def _csv_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends of all kinds, in files whose lines end in all kinds."""
    text = F.expr(
        "replace(text, '\\n', CASE doc_id % 3 WHEN 0 THEN '\\n' WHEN 1 THEN '\\r' ELSE '\\r\\n' END)"
    )
    cells = F.array(F.col("doc_id").cast("string"), text, F.col("lang"))
    lines = recipes.given(spark, sf_dir, "documents").select("doc_id", csv_line(cells).alias("line"))
    # Two documents to a line feed: the first ends in a carriage return, the second in either.
    pairs = lines.groupBy(F.floor(F.col("doc_id") / 2).alias("key")).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("doc_id", "line")))["line"], "\r").alias("line")
    )
    end = F.when(F.col("key") % 2 == 0, "\n").otherwise("\r\n")
    folder = new_folder(spark, "csv")
    ended = pairs.select("key", F.concat("line", end).alias("line"))
    recipes.csv_lines(ended, "doc_id,text,lang\r\n", f"{folder}/line ends.csv")
    database = recipes.run_database(spark)
    ingest_folder(spark, folder, database)
    return spark.table(f"{database}.line_ends")


def _csv_repeated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header that names two columns alike and leaves one without a name."""
    cells = [F.col(c).cast("string") for c in ("n_nationkey", "n_name", "n_regionkey", "n_name")]
    nations = recipes.given(spark, sf_dir, "nation")
    lines = nations.select(
        F.col("n_nationkey").cast("long").alias("key"),
        F.concat(csv_line(F.array(*cells)), F.lit("\n")).alias("line"),
    )
    folder = new_folder(spark, "csv")
    recipes.csv_lines(lines, "key,name,,name\n", f"{folder}/nation.csv")
    database = recipes.run_database(spark)
    ingest_folder(spark, folder, database)
    return spark.table(f"{database}.nation")


def _csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a file that cannot be loaded and one that is no CSV."""
    orders = recipes.given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    folder = recipes.csv_folder(spark, {"good.csv": orders, "notes.txt": orders})
    more = F.when(F.col("o_orderkey") % 2 == 0, ",more").otherwise("")
    cells = F.array(F.col("o_orderkey").cast("string"), F.col("o_orderstatus"))
    lines = orders.select(
        F.col("o_orderkey").cast("long").alias("key"),
        F.concat(csv_line(cells), more, F.lit("\n")).alias("line"),
    )
    recipes.csv_lines(lines, "o_orderkey,o_orderstatus\n", f"{folder}/bad.csv")
    return ingest_folder(spark, folder, recipes.run_database(spark)).select(
        "table", "rows", "error"
    )


def _csv_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was loaded, read, and loaded again with other content."""
    database = recipes.run_database(spark)
    customer = recipes.given(spark, sf_dir, "customer")
    supplier = recipes.given(spark, sf_dir, "supplier")
    contents = [
        customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
        supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
    ]
    rows = []
    for content in contents:
        folder = recipes.csv_folder(spark, {"party.csv": content})
        ingest_folder(spark, folder, database, split_bytes=0)
        rows.append(spark.table(f"{database}.party").count())
    return spark.table(f"{database}.party").withColumn("rows_before", F.lit(rows[0]).cast("long"))


def _csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that come in four files, with runs that end before and after they commit."""
    orders = recipes.given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folder, database = new_folder(spark, "csv"), recipes.run_database(spark)

    def arrive(part: int) -> None:
        export_csv(orders.where(F.col("o_orderkey") % 4 == part), f"{folder}/orders-{part}.csv")

    target = AppendTable(spark, "orders", database)
    arrive(0)
    append_folder(spark, folder, "orders", database)
    arrive(1)
    target.stage(folder)  # ends before its commit
    append_folder(spark, folder, "orders", database)
    arrive(2)
    target.commit(target.stage(folder))  # ends after its commit
    arrive(3)
    append_folder(spark, folder, "orders", database)
    append_folder(spark, folder, "orders", database)  # finds nothing new
    return spark.table(f"{database}.orders").withColumnRenamed(LOAD, "load")


def _csv_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem that comes in three waves, and a file at fault; a run ends before it loads."""
    lines = recipes.given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    folder, database = new_folder(spark, "csv"), recipes.run_database(spark)

    def arrive(part: int) -> None:
        export_csv(lines.where(F.col("l_orderkey") % 3 == part), f"{folder}/lines-{part}.csv")

    arrive(0)
    append_arrivals(spark, folder, "lines", database)
    arrive(1)
    Arrivals(spark, folder, "lines", database).notice()  # ends before it loads
    arrive(2)
    append_arrivals(spark, folder, "lines", database)
    export_csv(lines.select("l_linestatus").distinct(), f"{folder}/states.csv")  # has other columns
    append_arrivals(spark, folder, "lines", database)
    return spark.table(f"{database}.lines").withColumnRenamed(LOAD, "load")


#: Arrays of the raw history, by event: none, an empty one, or one to three objects.
NESTED = {
    "DIRECT_OBJECTS_ACCESSED": ("direct", 5),
    "BASE_OBJECTS_ACCESSED": ("base", 4),
    "OBJECTS_MODIFIED": ("modified", 3),
}


def _flattened_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    def nested(kind: str, divisor: int) -> str:
        return f"""CASE WHEN event_id % {divisor} = 0 THEN NULL ELSE transform(
            sequence(0, 2), i -> named_struct('objectName', concat('{kind} ', event_type, CAST(i AS STRING)),
                'objectDomain', 'Table', 'objectId', event_id * 10 + i,
                'stageKind', CASE WHEN i = 1 THEN 'Internal' END, 'columns', array('c'))) END"""

    def cut(kind: str, divisor: int) -> str:
        return f"slice({nested(kind, divisor)}, 1, CAST(event_id % {divisor} - 1 AS INT))"

    events = recipes.given(spark, sf_dir, "events").where("event_id IS NOT NULL")
    raw = events.select(
        F.col("event_id").cast("string").alias("QUERY_ID"),
        F.col("ts").alias("QUERY_START_TIME"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("USER_NAME"),
        F.lit(None).cast("string").alias("PARENT_QUERY_ID"),
        F.col("event_id").cast("string").alias("ROOT_QUERY_ID"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN props END").alias("OBJECT_MODIFIED_BY_DDL"),
        *[F.expr(cut(*spec)).alias(name) for name, spec in NESTED.items()],
    )
    # One of the arrays comes as text, as a variant would.
    raw = raw.withColumn("OBJECTS_MODIFIED", F.to_json("OBJECTS_MODIFIED"))
    return flatten_access_history(raw)


def _text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    orders = recipes.given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"),
        F.col("o_custkey").alias("3-customer"),
        priority.alias("priority (open)"),
    )
    return save_as_text(orders, "orders_text", recipes.run_database(spark))


def _positional_load(empty_below: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kind = F.when(F.col("p_size") < empty_below, "").otherwise(F.col("p_type"))
        parts = recipes.given(spark, sf_dir, "part").select(
            "p_partkey", "p_name", "p_brand", kind.alias("p_type")
        )
        folder = recipes.csv_folder(spark, {"part.csv": parts})
        return positional_load(
            spark, f"{folder}/part.csv", PARTS, "parts", recipes.run_database(spark)
        )

    return run


def _sheet_union_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as sheets with an empty column and empty rows."""
    customer, supplier = (
        recipes.given(spark, sf_dir, "customer"),
        recipes.given(spark, sf_dir, "supplier"),
    )
    customers = customer.select(
        *[
            F.when(F.col("c_nationkey") > 0, F.col(column)).alias(name)
            for column, name in [
                ("c_custkey", "key"),
                ("c_name", "name"),
                ("c_mktsegment", "segment"),
            ]
        ],
        F.lit(None).cast("string").alias("remark"),
    )
    suppliers = supplier.select(
        F.lit(None).cast("string").alias("remark"),
        *[
            F.when(F.col("s_nationkey") > 0, F.col(column)).alias(name)
            for column, name in [
                ("s_nationkey", "nation"),
                ("s_name", "name"),
                ("s_suppkey", "key"),
            ]
        ],
    )
    path = new_folder(spark, "combined")
    export_csv(combine_sheets({"customers": customers, "suppliers": suppliers}), path)
    return read_csv_text(spark, path).drop(RAW)


def _order_books(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    orders = recipes.given(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_custkey",
        "o_orderpriority",
        "o_orderdate",
        (F.col("o_orderstatus") == "O").alias("is_open"),
    )
    sheets = {
        "orders": ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "is_open"],
        "owners": ["o_orderkey", "o_custkey"],
    }
    return recipes.workbook_folder(orders, sheets, "o_orderkey", damaged)


def _workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every workbook with the rows of its first sheet."""
    rows = sheet_rows(scan_workbooks(spark, _order_books(spark, sf_dir)))
    name = F.regexp_extract("path", "([^/]*)$", 1).alias("name")
    return rows.where("row > 0").groupBy(name).agg(F.count("*").alias("rows"))


def _workbook_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workbook of the folder, by its name."""
    return first_sheet(spark, f"{_order_books(spark, sf_dir)}/book 0.xlsx")


def _workbook_first_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_sheet(spark, _order_books(spark, sf_dir))


def _workbook_all_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = all_sheets(spark, _order_books(spark, sf_dir))
    orders, owners = (df.withColumn("sheet", F.lit(name)) for name, df in sheets.items())
    return orders.unionByName(owners, allowMissingColumns=True)


def _workbook_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "combined")
    combine_workbook(spark, _order_books(spark, sf_dir), out)
    return read_csv_text(spark, out).drop(RAW)


def _workbook_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks to CSV to tables; the rows of all tables."""
    out, database = new_folder(spark, "from-workbooks"), recipes.run_database(spark)
    ingest_workbooks(spark, _order_books(spark, sf_dir), out).count()
    status = ingest_folder(spark, out, database).where("error IS NULL").collect()
    return read_tables(spark, database, [row["table"] for row in status])


def _workbook_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of workbooks of which half end halfway, and the rows that got into tables."""
    out, database = new_folder(spark, "from-workbooks"), recipes.run_database(spark)
    books = ingest_workbooks(spark, _order_books(spark, sf_dir, damaged=True), out)
    books = books.select("csv", "rows", F.col("error").isNotNull().alias("failed"))
    loaded = ingest_folder(spark, out, database).select(
        F.regexp_extract("path", r"([^/=]*)$", 1).alias("csv"), F.col("rows").alias("loaded")
    )
    loaded = loaded.withColumn("csv", F.replace("csv", F.lit("%20"), F.lit(" ")))
    return books.join(loaded, "csv", "left")


def _csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which many have a missing value that is spelled out."""
    cells = [F.expr(cell).alias(name) for name, cell in SPELLED.items()]
    documents = recipes.given(spark, sf_dir, "documents").select("doc_id", *cells)
    database = recipes.run_database(spark)
    ingest_folder(spark, recipes.csv_folder(spark, {"spelled.csv": documents}), database)
    return spark.table(f"{database}.spelled")


#: Tokens of missing values in turn, some other spellings of them among, which are text.
SPELLINGS = [*NULL_TOKENS, "Null", " NA", "na", "N/A.", "nil", "-"]
SPELLED = {
    "text": "CASE WHEN doc_id % 5 = 0 THEN {} ELSE text END",
    "lang": "CASE WHEN doc_id % 3 = 1 THEN {} ELSE lang END",
    "source": "CASE WHEN doc_id % 7 < 5 THEN {} ELSE source END",
}
_SPELLED = " ".join(f"WHEN {i} THEN '{token}'" for i, token in enumerate(SPELLINGS))
SPELLED = {
    name: cell.format(f"CASE (doc_id DIV 2) % {len(SPELLINGS)} {_SPELLED} END") for name, cell in SPELLED.items()
}


def queries() -> dict[str, Query]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    found = usage_and_ingest()
    if corpus_pipeline:
        corpus = corpus_queries.queries() | {"pipeline": corpus_pipeline.run}
        found |= {name: _with_folder(query) for name, query in corpus.items()}
    return found


def _with_folder(query: Query) -> Query:
    return lambda spark, sf_dir: query(recipes.ready(spark), sf_dir)


def oracle_sql() -> dict[str, str]:
    """The same results as SQL on the given tables, where SQL can express them."""
    found = usage_and_ingest_sql()
    if corpus_pipeline:
        found |= corpus_oracles.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def usage_and_ingest() -> dict[str, Query]:
    relational: dict[str, Query] = {
        "access_history_projection": _history,
        "object_usage": lambda spark, sf_dir: object_usage(_history(spark, sf_dir)),
        "unused_objects": _unused("rows"),
        "unused_objects_counted": _unused("count"),
        "unused_objects_distinct": _unused("distinct"),
        "unused_objects_incremental": _unused_objects_incremental,
        "dim_access_history": _dim_access_history,
        "object_mentions": lambda spark, sf_dir: object_mentions(
            _query_log(spark, sf_dir), "db.sales.click"
        ),
        "stale_rows": lambda spark, sf_dir: stale_rows(
            _audited(spark, sf_dir), CHECK_INTERVAL, CHECK_AS_OF
        ),
        "data_check": _data_check,
        "check_table": _check_table,
        "all_object_mentions": _all_object_mentions,
        "check_all_tables": _check_all_tables,
        "flattened_history": _flattened_history,
        "identifier_mentions": _identifier_mentions,
    }
    ingest: dict[str, Query] = {
        "csv_ingest": _csv_ingest(None),
        "csv_ingest_in_splits": _csv_ingest(0),
        "csv_roundtrip": _csv_roundtrip,
        "csv_folder_ingest": _csv_folder_ingest,
        "csv_line_ends": _csv_line_ends,
        "csv_inferred_text": _csv_inferred_text,
        "csv_repeated_headers": _csv_repeated_headers,
        "csv_report": _csv_report,
        "csv_reload": _csv_reload,
        "csv_append": _csv_append,
        "csv_arrivals": _csv_arrivals,
        "csv_null_tokens": _csv_null_tokens,
        "text_table": _text_table,
        "positional_load": _positional_load(0),
        "positional_load_nulls": _positional_load(10),
        "sheet_union_clean": _sheet_union_clean,
        "workbook_scan": _workbook_scan,
        "workbook_one": _workbook_one,
        "workbook_first_sheet": _workbook_first_sheet,
        "workbook_all_sheets": _workbook_all_sheets,
        "workbook_combined": _workbook_combined,
        "workbook_ingest": _workbook_ingest,
        "workbook_report": _workbook_report,
    }

    def in_utc(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return query(recipes.ready(spark), sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)

        return run

    return {name: in_utc(query) for name, query in (relational | ingest).items()}


def usage_and_ingest_sql() -> dict[str, str]:
    history = f"WITH history AS ({recipes.HISTORY_SQL})"
    usage = """SELECT base_object_name AS base_object_name, user_name AS user_name, max(query_start_time) AS last_usage,
            count(*) AS usage_count
        FROM history
        WHERE user_name IS NOT NULL AND object_modified_by_ddl IS NOT NULL
        GROUP BY base_object_name, user_name"""
    days = "date_diff('day', used.last_usage, TIMESTAMP '2024-04-20 12:00:00')"
    report = recipes.UNUSED_SQL.format(history="history", days=days)
    unused = f"{history}, unused_objects AS ({report})"
    log = recipes.QUERY_LOG_SQL.format("DB.SALES")
    mentions = f"""SELECT max(end_time) AS last_usage, count(*) AS query_count
        FROM ({log}) WHERE query_text ILIKE '%db.sales.click%'"""
    older = "last_accessed_timestamp < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 90 DAY"
    check = f"""SELECT last_usage, query_count, count(*) AS unused_data_count
        FROM ({mentions}) JOIN ({recipes.AUDITED_SQL}) ON {older}
        GROUP BY last_usage, query_count"""

    named = ", ".join(f"('{name}')" for name in dict.fromkeys(NAMES))
    queried = QUERIES_SQL.replace("AS STRING", "AS VARCHAR")
    mentioned = f"""SELECT object_name, max(end_time) AS last_usage, count(end_time) AS query_count
        FROM ({{}}) LEFT JOIN ({queried}) ON query_text ILIKE '%' || object_name || '%'
        GROUP BY object_name"""
    all_mentions = mentioned.format(f"SELECT * FROM (VALUES {named}) AS names(object_name)")
    audited = " UNION ALL ".join(
        f"""SELECT 'db.sales.{kind}' AS object_name, o_orderdate AS last_accessed_timestamp
            FROM orders WHERE o_orderstatus = '{status}'"""
        for kind, status in AUDITED.items()
    )
    all_checks = f"""SELECT * FROM ({mentioned.format(f"SELECT DISTINCT object_name FROM ({audited})")})
        JOIN (SELECT object_name, count(*) AS unused_data_count
              FROM ({audited}) WHERE {older} GROUP BY object_name) USING (object_name)"""
    # What the texts name, by how they were made.
    by_identifier = """WITH written AS (
            SELECT event_id % 8 AS way, event_type AS kind, upper(event_type) AS upper_kind, ts FROM events),
        named AS (
            SELECT 'SALES' AS s, upper_kind AS o, ts FROM written WHERE way IN (0, 1, 2, 6)
            UNION ALL SELECT 'SALES', upper_kind || '2', ts FROM written WHERE way = 3
            UNION ALL SELECT 'SALES', kind, ts FROM written WHERE way = 5),
        kinds AS (SELECT DISTINCT kind, upper_kind FROM written),
        objects AS (
            SELECT s, o FROM (SELECT unnest([upper_kind, upper_kind || '2', kind]) AS o FROM kinds),
                (VALUES ('SALES'), ('OTHER')) AS v(s))
        SELECT 'DB' AS object_database, s AS object_schema, o AS object_name,
               max(ts) AS last_usage, count(ts) AS query_count
        FROM objects LEFT JOIN named USING (s, o) GROUP BY s, o"""

    # Objects 0 up to as many as there are; a query without any has one without a name.
    def unnested(kind: str, divisor: int) -> str:
        return f"""unnest(CASE WHEN event_id % {divisor} <= 1 THEN [NULL]
            ELSE range(event_id % {divisor} - 1) END) AS {kind}"""

    def object_columns(prefix: str, kind: str) -> str:
        known = f"CASE WHEN {kind} IS NOT NULL THEN"
        return f"""{known} 'Table' END AS {prefix}_OBJECT_DOMAIN,
            event_id * 10 + {kind} AS {prefix}_OBJECT_ID,
            {known} concat('{kind} ', event_type, CAST({kind} AS VARCHAR)) END AS {prefix}_OBJECT_NAME,
            CASE WHEN {kind} = 1 THEN 'Internal' END AS {prefix}_OBJECT_STAGE_KIND"""

    flattened = "SELECT * FROM events"
    for spec in NESTED.values():
        flattened = f"SELECT *, {unnested(*spec)} FROM ({flattened})"
    flattened = f"""SELECT CAST(event_id AS VARCHAR) AS QUERY_ID, ts AS QUERY_START_TIME,
            'U' || CAST(user_id AS VARCHAR) AS USER_NAME, CAST(NULL AS VARCHAR) AS PARENT_QUERY_ID,
            CASE WHEN event_id % 3 = 0 THEN props END AS OBJECT_MODIFIED_BY_DDL,
            CAST(event_id AS VARCHAR) AS ROOT_QUERY_ID, {object_columns("DIRECT", "direct")},
            {object_columns("BASE", "base")}, {object_columns("MODIFIED", "modified")}
        FROM ({flattened})"""

    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)

    def text(column: str) -> str:
        return f"coalesce(CAST({column} AS VARCHAR), '')"

    def read(column: str) -> str:
        return f"CASE WHEN {column} IN ({tokens}) THEN '' ELSE {text(column)} END"

    documents = f"""SELECT {text("doc_id")} AS doc_id_, {read("text")} AS "Text_Body",
        {read("lang")} AS "2_letter_lang", {read("source")} AS source,
        {text("n_chars")} AS "Größe" FROM documents"""
    loaded = " UNION ALL ".join(
        f"""SELECT '{table_name(file)}' AS "table", (SELECT count(*) FROM {table}) AS "rows",
            {", ".join(f"{read(f'CAST({name} AS VARCHAR)')} AS column_{i}" for i, name in enumerate(columns))}
            FROM {table}"""
        for file, (table, columns) in EXPORTS.items()
    )

    spelled = ", ".join(
        f"{read(f'({cell})'.replace(' DIV ', ' // '))} AS {name}" for name, cell in SPELLED.items()
    )
    spelled = f"SELECT {text('doc_id')} AS doc_id, {spelled} FROM documents"

    def ended(text: str) -> str:
        return f"""replace({text}, chr(10), CASE doc_id % 3 WHEN 0 THEN chr(10)
            WHEN 1 THEN chr(13) ELSE chr(13) || chr(10) END)"""

    def typed(name: str, kinds: list[str]) -> str:
        def cell(column: str, given: str, kind: str) -> str:
            given = given.replace("AS STRING", "AS VARCHAR")
            known = f"""CASE WHEN ({given}) IN ({tokens}) THEN NULL ELSE ({given}) END"""
            value = {
                "integer": f"CAST(CAST(trim({known}) AS HUGEINT) AS VARCHAR)",
                "decimal": f"CAST(CAST(trim({known}) AS DOUBLE) AS VARCHAR)",
                "boolean": f"CASE lower({known}) WHEN 'true' THEN 'True' WHEN 'false' THEN 'False' END",
                "text": known,
            }[kind]
            return f"""coalesce({value}, '') AS "{column.replace(" ", "_")}" """

        cells = [cell(*cell_of, kind) for cell_of, kind in zip(TYPED[name].items(), kinds, strict=True)]
        return f"""SELECT {", ".join(cells)}, '{name}' AS "table" FROM {name}"""

    inferred = " UNION ALL ".join(
        [
            typed("lineitem", ["integer", "decimal", "decimal", "decimal", "boolean", "text"]),
            typed("part", ["integer", "decimal", "text", "decimal", "boolean", "text"]),
        ]
    )

    report_rows = """SELECT 'good' AS "table", count(*) AS "rows", NULL AS error FROM orders
        UNION ALL SELECT 'bad', NULL, CAST(count(*) AS VARCHAR) || ' records with more than 2 fields'
        FROM orders WHERE o_orderkey % 2 = 0"""

    def places(kind: str) -> str:
        return f"""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
            nullif({kind}, '') AS p_type FROM part"""

    sheets = f"""SELECT {text("key")} AS key, {text("name")} AS name,
            {text("segment")} AS segment, {text("nation")} AS nation
        FROM (SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment
              FROM customer WHERE c_nationkey > 0
              UNION ALL BY NAME
              SELECT s_nationkey AS nation, s_name AS name, s_suppkey AS key
              FROM supplier WHERE s_nationkey > 0)"""
    orders = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
            strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
            CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END AS is_open {}
        FROM orders"""
    owners = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
            CAST(o_custkey AS VARCHAR) AS o_custkey, 'owners' AS sheet FROM orders"""
    sheet_columns = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    sheet_columns += ["is_open", "o_custkey"]
    combined = """SELECT {} FROM ({} UNION ALL BY NAME
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
               CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders)""".format(
        ", ".join(f"{text(column)} AS {column}" for column in sheet_columns), orders.format("")
    )
    book = f"CAST(o_orderkey // {recipes.BOOK_ROWS} AS VARCHAR)"
    return {
        "access_history_projection": recipes.HISTORY_SQL,
        "object_usage": f"{history} {usage}",
        "unused_objects": f"{unused} SELECT * FROM unused_objects",
        "unused_objects_counted": f"""{unused} SELECT *, count(*) AS fan_out
            FROM unused_objects GROUP BY ALL""",
        "unused_objects_incremental": f"{unused} SELECT * FROM unused_objects",
        "unused_objects_distinct": f"{unused} SELECT DISTINCT * FROM unused_objects",
        "dim_access_history": recipes.HISTORY_SQL,
        "object_mentions": mentions,
        "stale_rows": f"SELECT * FROM ({recipes.AUDITED_SQL}) WHERE {older}",
        "data_check": check,
        "check_table": check,
        "all_object_mentions": all_mentions,
        "check_all_tables": all_checks,
        "flattened_history": flattened,
        "identifier_mentions": by_identifier,
        "csv_ingest": documents,
        "csv_ingest_in_splits": documents,
        "csv_roundtrip": f"""SELECT {text("o_orderkey")} AS o_orderkey,
            {text("o_custkey")} AS o_custkey, {text("o_orderstatus")} AS o_orderstatus,
            {text("o_orderpriority")} AS o_orderpriority FROM orders""",
        "csv_folder_ingest": loaded,
        "csv_line_ends": f"""SELECT {text("doc_id")} AS doc_id, {ended(read("text"))} AS text,
            {read("lang")} AS lang FROM documents""",
        "csv_inferred_text": inferred,
        "csv_null_tokens": spelled,
        "csv_repeated_headers": f"""SELECT {text("n_nationkey")} AS key, {text("n_name")} AS name,
            {text("n_regionkey")} AS "Unnamed_2", {text("n_name")} AS name_1 FROM nation""",
        "csv_report": report_rows,
        "csv_reload": f"""SELECT {text("s_suppkey")} AS key, s_name AS name,
            (SELECT count(*) FROM customer) AS rows_before FROM supplier""",
        "csv_append": f"""SELECT {text("o_orderkey")} AS o_orderkey, {text("o_custkey")} AS o_custkey,
            {text("o_orderpriority")} AS o_orderpriority, '0000000' || (1 + o_orderkey % 4) AS load
            FROM orders""",
        "csv_arrivals": f"""SELECT {text("l_orderkey")} AS l_orderkey, {text("l_linenumber")} AS l_linenumber,
            {text("l_linestatus")} AS l_linestatus,
            CASE WHEN l_orderkey % 3 = 0 THEN '00000001' ELSE '00000002' END AS load
            FROM lineitem""",
        "text_table": f"""SELECT {text("o_orderkey")} AS order_key,
            {text("o_custkey")} AS "3_customer",
            CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority ELSE '' END AS priority_open_
            FROM orders""",
        "positional_load": places("p_type"),
        "positional_load_nulls": places("CASE WHEN p_size < 10 THEN '' ELSE p_type END"),
        "sheet_union_clean": sheets,
        "workbook_scan": f"""SELECT 'book ' || {book} || '.xlsx' AS name, count(*) AS "rows"
            FROM orders GROUP BY ALL""",
        "workbook_one": f"{orders.format('')} WHERE o_orderkey // {recipes.BOOK_ROWS} = 0",
        "workbook_first_sheet": orders.format(""),
        "workbook_all_sheets": f"{orders.format(', ' + repr('orders') + ' AS sheet')}"
        f" UNION ALL BY NAME {owners}",
        "workbook_combined": combined,
        "workbook_report": f"""WITH books AS (SELECT {book} AS book, count(*) AS n FROM orders GROUP BY 1)
            SELECT 'book ' || book || '.csv' AS csv, n AS "rows", false AS failed, n AS loaded FROM books
            UNION ALL SELECT 'damaged ' || book || '.csv', 0, true, NULL FROM books""",
        "workbook_ingest": orders.format(f""", 'book_' || {book} AS "table" """),
    }
