"""The six messy landing extracts, derived from the driver tables.

The reference loads six CSV exports whose text is deliberately untidy (mixed
date formats, ``$`` prices, boolean spellings, blank keys, duplicate customer
rows).  Here the same kinds of mess are put deterministically into frames
derived from the driver's star tables, so every downstream job reads the
given tables and grows with them.  All columns are strings, as in landing.

Which row gets which kind of mess is picked by a rule on its key (the
"mess rules" below); these rules decide *how a row looks*, never *whether a
row is read*: every input row is kept.

``write_landing_csv`` / ``scan_raw_csv`` round-trip the frames through CSV
with the quoting rules of the source's bulk loader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.constants import PAYMENT_METHODS, RETURN_REASONS
from martforge.functions.clean import line_total
from martforge.operators.ranking import with_global_rank
from martforge.session import STORED_CODEC, dropping_shuffles
from martforge.sources.driver import read_table

# --- mess rules (fixed values) ---------------------------------------------
SIGNUP_EPOCH = "1995-01-01"        # signup = epoch + (custkey mod 900) days
SIGNUP_SPREAD_DAYS = 900
EMAIL_DOMAIN = "@example.com"
EMAIL_BLANK_EVERY = 50             # custkey mod 50 = 0   -> blank e-mail
EMAIL_UPPER_EVERY = 33             # custkey mod 33 = 0   -> upper-case e-mail
EMAIL_PADDED_EVERY = 7             # custkey mod 7 = 0    -> e-mail with spaces
SIGNUP_JUNK_EVERY = 97             # custkey mod 97 = 0   -> signup text 'n/a'
DUPLICATE_EVERY = 200              # custkey mod 200 = 0  -> exact duplicate row
REDATED_EVERY = 300                # custkey mod 300 = 150 -> second row, later signup
REDATED_OFFSET = 150
REDATED_SHIFT_DAYS = 400
CATEGORY_BLANK_EVERY = 100         # partkey mod 100 = 0  -> blank category
PRICE_DOLLAR_MOD = 5               # partkey mod 5 < 2    -> '$' price
ACTIVE_SPELLINGS = ["true", "false", "TRUE", "1"]   # by partkey mod 4
ORDER_DATE_JUNK_EVERY = 499        # orderkey mod 499 = 0 -> order date 'unknown'
# status by orderkey mod 20: 0 placed, 1-2 shipped, 3-15 delivered,
# 16-17 cancelled, 18-19 returned (weights 5/10/65/10/10)
STATUS_BY_MOD20 = [(0, 0, "placed"), (1, 2, "shipped"), (3, 15, "delivered"),
                   (16, 17, "cancelled"), (18, 19, "returned")]
SHIPPING_CENTS_MOD = 1500          # shipping = (orderkey mod 1500) cents
RETURN_FLAG = "R"                  # lines flagged R are returned
RETURN_DELAY_BASE = 2              # return date = ship date + 2 + (n mod 29) days
RETURN_DELAY_SPREAD = 29
REFUND_SHARE = "0.9"               # refund = round(line total * 0.9, 2)
ID_WIDTH = {"CUST": 10, "PROD": 10, "ORD": 12, "OI": 12, "RET": 12}


def source_id(prefix: str, c: Column) -> Column:
    """``PREFIX-0000123``: padded to a least width, longer keys stay whole."""
    key = c.cast("string")
    width = ID_WIDTH[prefix]
    return F.concat(F.lit(prefix + "-"), F.when(F.length(key) < width, F.lpad(key, width, "0")).otherwise(key))


def _pick(index: Column, values: list[str]) -> Column:
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


def _cents_text(cents: Column) -> Column:
    """Whole cents to ``'123.45'`` with integer arithmetic only."""
    return F.concat(
        F.floor(cents / 100).cast("long").cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def _date_text(d: Column, iso: Column) -> Column:
    return F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy"))


# --- the six landing frames ---------------------------------------------------

def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # nation and region are fixed-size code tables (25 and 5 rows)
    base = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(
        F.broadcast(r), n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    mail = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit(EMAIL_DOMAIN))
    email = (
        F.when(k % EMAIL_BLANK_EVERY == 0, F.lit(""))
        .when(k % EMAIL_UPPER_EVERY == 0, F.upper(mail))
        .when(k % EMAIL_PADDED_EVERY == 0, F.concat(F.lit("  "), mail, F.lit(" ")))
        .otherwise(mail)
    )
    signup = F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), (k % SIGNUP_SPREAD_DAYS).cast("int"))
    rows = base.select(
        k,
        source_id("CUST", k).alias("customer_id"),
        F.col("c_name").alias("full_name"),
        email.alias("email"),
        signup.alias("_signup"),
        F.concat(F.lit("City-"), F.col("c_nationkey").cast("string"), F.lit("-"),
                 (k % 10).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
        F.lower(F.col("c_mktsegment")).alias("segment"),
    )

    def finish(df: DataFrame, signup_text: Column) -> DataFrame:
        return df.select("customer_id", "full_name", "email",
                         signup_text.alias("signup_date"), "city", "state", "country", "segment")

    first = finish(rows, F.when(k % SIGNUP_JUNK_EVERY == 0, F.lit("n/a"))
                   .otherwise(_date_text(F.col("_signup"), k % 2 == 0)))
    dup = finish(rows.filter(k % DUPLICATE_EVERY == 0),
                 F.when(k % SIGNUP_JUNK_EVERY == 0, F.lit("n/a"))
                 .otherwise(_date_text(F.col("_signup"), k % 2 == 0)))
    later = F.date_add(F.col("_signup"), REDATED_SHIFT_DAYS)
    redated = finish(rows.filter(k % REDATED_EVERY == REDATED_OFFSET),
                     _date_text(later, k % 2 == 1))
    return first.unionByName(dup).unionByName(redated)


def _category_levels(part: DataFrame) -> tuple[Column, Column, Column]:
    root_id = F.concat(F.lit("CAT-"), F.col("p_type"))
    mid_id = F.concat(root_id, F.lit("-"), F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("B")))
    leaf_id = F.concat(mid_id, F.lit("-S"), F.floor(F.col("p_size") / 10).cast("int").cast("string"))
    return root_id, mid_id, leaf_id


def categories_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-level tree: type -> type/brand -> type/brand/size band."""
    part = read_table(spark, sf_dir, "part", ["p_type", "p_brand", "p_size"])
    root_id, mid_id, leaf_id = _category_levels(part)
    band = F.floor(F.col("p_size") / 10).cast("int").cast("string")
    roots = part.select(root_id.alias("category_id"), F.col("p_type").alias("category_name"),
                        F.lit("").alias("parent_category_id"))
    mids = part.select(mid_id.alias("category_id"),
                       F.concat_ws(" ", "p_type", "p_brand").alias("category_name"),
                       root_id.alias("parent_category_id"))
    leaves = part.select(leaf_id.alias("category_id"),
                         F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand"), F.lit(" size band "), band)
                         .alias("category_name"),
                         mid_id.alias("parent_category_id"))
    # distinct per level: a partial aggregate, bounded by the number of
    # type x brand x band combinations, not by the number of parts
    return roots.distinct().unionByName(mids.distinct()).unionByName(leaves.distinct())


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    _, _, leaf_id = _category_levels(part)
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    return part.select(
        source_id("PROD", k).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(k % CATEGORY_BLANK_EVERY == 0, F.lit("")).otherwise(leaf_id).alias("category_id"),
        F.col("p_brand").alias("brand"),
        F.when(k % PRICE_DOLLAR_MOD < 2, F.concat(F.lit("$"), price)).otherwise(price).alias("unit_price"),
        _pick(k % 4, ACTIVE_SPELLINGS).alias("is_active"),
    )


def _status(k: Column) -> Column:
    m = k % 20
    expr = None
    for lo, hi, name in STATUS_BY_MOD20:
        cond = m.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        source_id("ORD", k).alias("order_id"),
        source_id("CUST", F.col("o_custkey")).alias("customer_id"),
        F.when(k % ORDER_DATE_JUNK_EVERY == 0, F.lit("unknown"))
        .otherwise(_date_text(d, k % 2 == 0)).alias("order_date"),
        _status(k).alias("order_status"),
        _pick(k % 4, PAYMENT_METHODS).alias("payment_method"),
        _cents_text(k % SHIPPING_CENTS_MOD).alias("shipping_cost"),
    )


LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]
# what the landing frames take from a numbered line
LINEITEM_KEPT = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
    "l_returnflag",
]


def numbered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a line number ``n`` over all columns.

    (l_orderkey, l_linenumber) repeats in the driver tables, whole rows do
    not, so the line id is the rank of the whole row.  The rank is computed
    by the parallel global ranking operator (range partitions + offsets),
    which also splits an order holding a third of all lines.  Columns that
    only order the lines are not kept.
    """
    li = read_table(spark, sf_dir, "lineitem", LINEITEM_ORDER)
    return with_global_rank(li, LINEITEM_ORDER, "n", keep=LINEITEM_KEPT)


def _unit_cents(q: Column) -> Column:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.floor(cents / q).cast("long")


def order_items_raw(numbered: DataFrame) -> DataFrame:
    q = F.col("l_quantity").cast("long")
    return numbered.select(
        source_id("OI", F.col("n")).alias("order_item_id"),
        source_id("ORD", F.col("l_orderkey")).alias("order_id"),
        source_id("PROD", F.col("l_partkey")).alias("product_id"),
        q.cast("string").alias("quantity"),
        _cents_text(_unit_cents(q)).alias("unit_price"),
        F.round(F.col("l_discount") * 100).cast("int").cast("string").alias("discount_pct"),
    )


def returns_raw(numbered: DataFrame) -> DataFrame:
    q = F.col("l_quantity").cast("long")
    unit = _cents_text(_unit_cents(q)).cast("decimal(10,2)")
    disc = F.round(F.col("l_discount") * 100).cast("int").cast("decimal(5,2)")
    total = line_total(q.cast("int"), unit, disc)
    refund = F.round(total * F.lit(REFUND_SHARE).cast("decimal(2,1)"), 2).cast("decimal(12,2)")
    delay = (RETURN_DELAY_BASE + F.col("n") % RETURN_DELAY_SPREAD).cast("int")
    returned = numbered.filter(F.col("l_returnflag") == RETURN_FLAG)
    return returned.select(
        source_id("RET", F.col("n")).alias("return_id"),
        source_id("OI", F.col("n")).alias("order_item_id"),
        F.date_format(F.date_add(F.col("l_shipdate").cast("date"), delay), "yyyy-MM-dd").alias("return_date"),
        _pick(F.col("l_linenumber") % 5, RETURN_REASONS).alias("return_reason"),
        refund.cast("string").alias("refund_amount"),
    )


LANDING_TABLES = ["categories", "customers", "products", "orders", "order_items", "returns"]


def landing_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six landing frames (``messy_landing``)."""
    numbered = numbered_lineitem(spark, sf_dir)
    return {
        "categories": categories_raw(spark, sf_dir),
        "customers": customers_raw(spark, sf_dir),
        "products": products_raw(spark, sf_dir),
        "orders": orders_raw(spark, sf_dir),
        "order_items": order_items_raw(numbered),
        "returns": returns_raw(numbered),
    }


# --- CSV landing -----------------------------------------------------------------

LANDING_COLUMNS = {
    "categories": ["category_id", "category_name", "parent_category_id"],
    "customers": ["customer_id", "full_name", "email", "signup_date", "city", "state",
                  "country", "segment"],
    "products": ["product_id", "product_name", "category_id", "brand", "unit_price", "is_active"],
    "orders": ["order_id", "customer_id", "order_date", "order_status", "payment_method",
               "shipping_cost"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_pct"],
    "returns": ["return_id", "order_item_id", "return_date", "return_reason", "refund_amount"],
}

# CSV dialect of the source's bulk loader: header, '"' quotes doubled inside
# a quoted field, fields may span lines, unquoted empty field = NULL.
# Blanks around a field belong to it.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# the ids of landing rows are long and much alike; a gzip file is read by one task, so its rows are bounded
ROWS_PER_FILE = 500_000


def landing_schema(table: str) -> T.StructType:
    """All-string schema of a landing table: nothing is inferred."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in LANDING_COLUMNS[table]])


def write_landing_csv(frames: dict[str, DataFrame], base_path: str, rows_per_file: int | None = None) -> dict[str, str]:
    """Write each landing frame as a header CSV folder (full refresh); with
    ``rows_per_file`` gzipped, in files of so many rows at most."""
    zipped = {"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": rows_per_file}
    paths = {}
    for name, df in frames.items():
        path = f"{base_path}/{name}.csv"
        with dropping_shuffles(df.sparkSession):
            (df.select(*LANDING_COLUMNS[name]).write.mode("overwrite")
             .options(**CSV_OPTIONS, **(zipped if rows_per_file else {})).option("emptyValue", '""').csv(path))
        paths[name] = path
    return paths


def fields_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether some quoted field of the CSV goes over the end of a line.

    Quotes open and close fields and are doubled inside, so a line that begins
    outside a field ends inside one if it holds an odd number of quotes.  The first
    line of a field that spans lines is such a line, and without one no line
    is.  Lines are read as text, in as many tasks as the files have splits."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def scan_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one landing CSV with a fixed all-string schema.

    Files are split over many tasks; only where a quoted field spans lines
    is a file read by one task, since no split can tell where its records begin.
    A ragged row, or a header other than the table's columns, fails the job (FAILFAST),
    as in the source's loader.  A
    quoted empty field reads as NULL in Spark but as '' in the source; the
    cleaning jobs apply ``nullif(x, '')`` wherever that difference matters.
    """
    spans = "true" if fields_span_lines(spark, path) else "false"
    return (spark.read.schema(landing_schema(table)).options(**CSV_OPTIONS).option("multiLine", spans)
            .option("enforceSchema", "false").option("mode", "FAILFAST").csv(path))


def csv_to_landing(spark: SparkSession, paths: dict[str, str], root: str) -> dict[str, DataFrame]:
    """The landing tables as Parquet under ``root``, each from its CSV (full refresh)."""
    out = {}
    for table, path in paths.items():
        scan_raw_csv(spark, path, table).write.mode("overwrite").option("compression", STORED_CODEC).parquet(f"{root}/{table}")
        out[table] = spark.read.schema(landing_schema(table)).parquet(f"{root}/{table}")
    return out


def csv_paths(csv_dir: str) -> dict[str, str]:
    """``<dir>/<table>.csv`` of every landing table, a file or a folder of files."""
    return {t: f"{csv_dir.rstrip('/')}/{t}.csv" for t in LANDING_TABLES}
