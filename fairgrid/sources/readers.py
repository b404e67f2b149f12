"""Readers of the source files (SRC-01 to SRC-13): encodings, newest files, HTML tables, wide matrices, nested JSON, polygons."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairgrid.functions import dates, numbers, text
from fairgrid.operators.frames import last_per_key, rename
from fairgrid.operators.stored import cut

#: Encodings of the source files, in the order in which they are tried.
ENCODINGS = ("UTF-8", "cp949", "euc-kr")

# Source headers (without blanks) and their canonical names; dates come first.
DATASETS = {
    "crude": {"기간": "date", "Dubai": "dubai", "Brent": "brent", "WTI": "wti"},
    "fx_usdkrw": {"변환": "date", "원자료": "usdkrw"},
    "intl_products": {"기간": "date", "휘발유95RON": "gasoline_95", "휘발유92RON": "gasoline_92", "등유": "kerosene", "경유0.001%": "diesel_0001", "경유0.05%": "diesel_005", "고유황중유": "fuel_oil", "나프타": "naphtha"},
    "retail_avg": {"구분": "date", "보통휘발유": "gasoline", "자동차용경유": "diesel"},
    "policy": {"정책명": "name", "시작일": "start", "종료일": "end", "유종": "fuel", "가격": "price", "카테고리": "category"},
    "station_raw": {"번호": "station_id", "지역": "region", "상호": "station_name", "주소": "address", "기간": "date", "상표": "brand", "셀프여부": "is_self", "휘발유": "gasoline", "경유": "diesel"},
}


def recode(source: str, target: str):
    """A vectorised function from one reading of a text's bytes to another; bytes that do not fit are replaced."""

    @F.pandas_udf("string")
    def other(values: pd.Series) -> pd.Series:
        return values.map(lambda s: None if s is None else s.encode(source, "replace").decode(target, "replace"))

    return other


def read_csv(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """SRC-01: a CSV of strings with a header; a byte-order mark on the first header goes.

    Code pages that Spark does not read are read byte for byte and decoded in vectorised batches.
    """
    plain = encoding.upper() == "UTF-8"
    df = spark.read.option("header", True).option("encoding", "UTF-8" if plain else "ISO-8859-1").csv(path)
    if not plain:
        heads = [c.encode("latin-1", "replace").decode(encoding, "replace") for c in df.columns]
        df = df.select(*[recode("latin-1", encoding)(F.col(f"`{c}`")).alias(h) for c, h in zip(df.columns, heads, strict=True)])
    return df.toDF(*[c.removeprefix("\ufeff").strip() for c in df.columns])


def read_csv_any(spark: SparkSession, path: str, expected: list[str], id_column: str | None = None, least: int | None = None) -> DataFrame:
    """SRC-01, SRC-02: the decoding under which most expected headers appear, then most ids match; an error below ``least`` headers.

    Only the headers are looked at, and the ids of candidates that tie are counted by one aggregate each.
    """
    best, score = None, (-1, -1)
    for encoding in ENCODINGS:
        df = read_csv(spark, path, encoding)
        hits = len(set(expected) & set(df.columns))
        ids = df.agg(F.count_if(text.is_station_id(F.col(id_column)))).first()[0] if hits and id_column in df.columns else 0
        if (hits, ids) > score:
            best, score = df, (hits, ids)
    if score[0] < (len(expected) if least is None else least):
        raise ValueError(f"{path}: {score[0]} of {len(expected)} expected headers in any encoding")
    return best


def newest_file(spark: SparkSession, folder: str, pattern: str, parents: str = "*") -> str:
    """SRC-03: the file that matches a glob, in a folder that matches ``parents``, and was changed last; names break ties."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", "modificationTime")
    if parents != "*":
        listed = listed.where(F.element_at(F.split("path", "/"), -2).like(parents.replace("_", r"\_").replace("*", "%")))
    found = listed.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()
    if found is None or found["path"] is None:
        raise FileNotFoundError(f"{folder}: nothing matches {pattern}")
    return found["path"]


class _Cells(HTMLParser):
    """The cells of all tables of a page. Cells and rows may be left open: the next one, or the end of their table, ends them; a
    table inside a cell has rows of its own and its text is no text of the cell around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done: list[tuple[int, int, int, str]] = []
        self.open: list[dict] = []
        self.tables = 0

    def _end_cell(self) -> None:
        t = self.open[-1]
        if t["text"] is not None:
            self.done.append((t["table"], t["row"], t["cell"], " ".join("".join(t["text"]).split())))
            t["text"], t["cell"] = None, t["cell"] + 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append({"table": self.tables, "row": -1, "cell": 0, "text": None})
            self.tables += 1
        elif self.open and tag in ("tr", "td", "th"):
            self._end_cell()
            t = self.open[-1]
            if tag == "tr" or t["row"] < 0:
                t["row"], t["cell"] = t["row"] + 1, 0
            if tag != "tr":
                t["text"] = []
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if self.open and tag in ("td", "th", "tr", "table"):
            self._end_cell()
            if tag == "table":
                self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)


@F.udtf(returnType="table_no int, row_no int, cell_no int, text string")
class HtmlCells:
    """UDF-03: a row for each cell of each table of a page, handed on while the page is read, some kilobytes at a time."""

    def eval(self, html: str):
        page = _Cells()
        for at in range(0, len(html or ""), 65_536):
            page.feed(html[at : at + 65_536])
            yield from page.done
            page.done = []
        page.close()
        while page.open:
            page.handle_endtag("table")
        yield from page.done


def html_cells(df: DataFrame, html: str) -> DataFrame:
    """UDF-03: ``df`` with table_no, row_no, cell_no and text of each cell of the tables in a column, by a lateral join; rows without cells go."""
    return df.lateralJoin(HtmlCells(F.col(html).outer()))


def read_html_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """SRC-04: the rows of a page's tables, whatever the file is called; rows shorter than ``columns`` and header rows go."""
    pages = spark.read.text(path, wholetext=True).select(F.monotonically_increasing_id().alias("page"), "value")
    cells = html_cells(pages, "value").where(F.col("cell_no") < len(columns))
    rows = cells.groupBy("page", "table_no", "row_no").agg(*[F.max(F.when(F.col("cell_no") == i, F.col("text"))).alias(n) for i, n in enumerate(columns)], F.count("*").alias("__n"))
    kept = rows.where((F.col("__n") == len(columns)) & dates.parse_date(F.col(columns[0])).isNotNull())
    return kept.orderBy("page", "table_no", "row_no").select(*columns)


def read_tax(spark: SparkSession, path: str) -> DataFrame:
    """SRC-04: fuel-tax changes: a date, five taxes, the total left out; '-' is missing."""
    taxes = ["customs", "transport", "education", "driving", "import_levy"]
    raw = read_html_table(spark, path, ["date", *taxes])
    return raw.select(dates.parse_date(F.col("date")).alias("date"), *[numbers.parse_number(F.col(t)).alias(t) for t in taxes])


def read_wide_prices(spark: SparkSession, paths: list[str], stations: list[str], fuel: str) -> DataFrame:
    """SRC-05: (date, station_id, price, fuel) of a matrix with a column for each station; only the wanted columns are read out."""
    df = read_csv(spark, paths)
    wanted = [s for s in stations if s in df.columns]
    prices = df.select(dates.parse_date(F.col("date")).alias("date"), *[numbers.parse_number(F.col(s)).alias(s) for s in wanted])
    return prices.unpivot("date", wanted, "station_id", "price").where("price > 0 and date is not null").withColumn("fuel", F.lit(fuel))


def write_price_matrix(df: DataFrame, path: str, columns: int = 200) -> None:
    """SRC-05: the opposite of ``read_price_matrix``, in one job: ``df`` (date, station_id, price) as matrices with a row for each date and some ``columns`` stations each, a
    folder for each block of stations. Stations are dealt to blocks by hash; a block's file is a header and a line a day."""
    n_blocks = -(-(df.agg(F.count_distinct("station_id")).first()[0] or 1) // columns)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = df.withColumn("block", F.pmod(F.xxhash64("station_id"), F.lit(n_blocks))).groupBy("block", "date", "station_id").agg(F.max("price").alias("price"))
    ids = df.select(F.pmod(F.xxhash64("station_id"), F.lit(n_blocks)).alias("block"), "station_id").distinct().groupBy("block").agg(F.sort_array(F.collect_list("station_id")).alias("ids"))
    column = ids.select("block", F.posexplode("ids").alias("__no", "station_id"), F.size("ids").alias("__n"))
    placed = cells.repartition(n_parts, "block", "station_id").join(column, ["block", "station_id"])
    days = placed.groupBy("block", "date", "__n").agg(F.sort_array(F.collect_list(F.struct("__no", F.col("price").cast("decimal(18,3)").cast("string").alias("v")))).alias("c"))
    # a value stands behind as many commas as columns lie between it and the one before, so that a line costs what its values cost
    before = lambda i: F.when(i > 0, F.get("c", i - 1)["__no"]).otherwise(-1)
    told = F.array_join(F.transform("c", lambda x, i: F.concat(F.repeat(F.lit(","), x["__no"] - before(i)), F.coalesce(x["v"], F.lit("")))), "")
    line = F.concat(F.date_format("date", "yyyyMMdd"), told, F.repeat(F.lit(","), F.col("__n") - 1 - F.element_at("c", -1)["__no"]))
    lines = days.select("block", F.date_format("date", "yyyyMMdd").alias("__at"), line.alias("value")).union(ids.select("block", F.lit(""), F.concat_ws(",", F.lit("date"), "ids")))
    lines.repartition(min(n_blocks, n_parts), "block").sortWithinPartitions("block", "__at").drop("__at").write.mode("overwrite").partitionBy("block").text(path)


def read_price_matrix(spark: SparkSession, path: str, fuel: str) -> DataFrame:
    """SRC-05: (date, station_id, price, fuel) of all blocks of a station matrix, each with a header of its own, in one job."""
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = spark.read.text(path).select("block", F.substring_index("value", ",", 1).alias("c0"), "value")
    heads = lines.where("c0 = 'date'").select("block", F.split("value", ",").alias("ids"))
    days = lines.where("c0 <> 'date'").withColumn("date", dates.parse_date(F.col("c0"))).where("date is not null").drop("c0")
    # many more tasks than lines would ask for: a line of a few hundred bytes becomes as many rows
    met = days.repartition(n_parts, "block").join(heads, "block")
    cells = met.select("date", "ids", F.posexplode(F.split("value", ",")).alias("no", "v")).where("no > 0 and v <> ''").select("date", F.get("ids", F.col("no")).alias("station_id"), numbers.parse_number(F.col("v")).alias("price"))
    return cells.where("price > 0 and station_id is not null").withColumn("fuel", F.lit(fuel))


_HISTORY = T.ArrayType(T.ArrayType(T.StringType()))
STATION_META = T.MapType(T.StringType(), T.StructType([*(T.StructField(n, T.StringType()) for n in ("region", "station_name", "address")), *(T.StructField(n, _HISTORY) for n in ("location", "brand", "is_self"))]))


def read_station_history(spark: SparkSession, path: str, field: str) -> DataFrame:
    """SRC-06, RSH-03: (station_id, effective_date, values) of one nested history field, a row for each entry."""
    meta = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", STATION_META)).alias("station_id", "info"))
    rows = meta.select("station_id", F.explode(F.col(f"info.{field}")).alias("e"))
    return rows.select("station_id", dates.parse_date(F.col("e")[0]).alias("effective_date"), F.slice("e", 2, F.greatest(F.size("e") - 1, F.lit(0))).alias("values")).where("effective_date is not null")


def read_polygons(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """SRC-07: (name, ordinal, rings) of the polygons of a GeoJSON file, short region names, file order kept."""
    point = "array<array<array<double>>>"
    features = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>").getField("features")).alias("ordinal", "f"))
    shape = F.when(F.col("f.geometry.type") == "MultiPolygon", F.from_json("f.geometry.coordinates", f"array<{point}>")).otherwise(F.array(F.from_json("f.geometry.coordinates", point)))
    return features.select(text.short_region(F.col("f.properties")[name]).alias("name"), "ordinal", F.explode(shape).alias("rings"))


def read_dataset(spark: SparkSession, path: str, dataset: str, encoding: str | None = None) -> DataFrame:
    """SRC-09: a daily source by its header map: dates parsed, all other columns numbers, sorted, rows without a date left out."""
    aliases = DATASETS[dataset]
    df = read_csv(spark, path, encoding) if encoding else read_csv_any(spark, path, [c for c in aliases if "(" not in c], least=1)
    df = rename(df, aliases)
    values = [c for c in aliases.values() if c != "date" and c in df.columns]
    return df.select(dates.parse_date(F.col("date")).alias("date"), *[numbers.parse_number(F.col(f"`{c}`")).alias(c) for c in values]).where("date is not null").orderBy("date")


def read_refinery_weeks(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SRC-10: weekly refinery prices by week label; the last row of a week wins."""
    df = rename(read_csv(spark, path, encoding), {"구분": "label", "보통휘발유": "gasoline", "자동차용경유": "diesel"}).withColumn("__at", F.monotonically_increasing_id())
    rows = df.select(dates.week_label_end(F.col("label")).alias("week_end"), numbers.parse_number(F.col("gasoline")).alias("gasoline"), numbers.parse_number(F.col("diesel")).alias("diesel"), "__at").where("week_end is not null")
    return last_per_key(rows, ["week_end"], [F.col("__at")]).drop("__at")


def read_policies(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SRC-11: policy intervals; rows without name, start or fuel go. A price in percent becomes a rate."""
    df = rename(read_csv(spark, path, encoding), DATASETS["policy"])
    out = df.select(F.trim("name").alias("name"), dates.parse_date(F.col("start")).alias("start"), dates.parse_date(F.col("end")).alias("end"), F.trim("fuel").alias("fuel"), numbers.parse_number(F.col("price")).alias("price"), numbers.parse_number(F.col("category")).cast("int").alias("category"))
    return out.dropna(subset=["name", "start", "fuel"]).withColumn("rate", F.abs("price") / 100)


def read_facilities(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SRC-12: facilities by any of their header spellings; ids F000001 and on in file order."""
    df = read_csv(spark, path, encoding)
    lower = {c.strip().lower(): c for c in df.columns}
    pick = lambda *names: next((F.col(f"`{lower[n]}`") for n in names if n in lower), F.lit(None).cast("string"))
    kind = pick("구분", "대상", "type", "상표")
    rows = df.select(kind.alias("kind"), pick("이름", "name").alias("name"), pick("주소", "address").alias("address"), numbers.parse_number(pick("경도", "lon", "longitude")).alias("lon"), numbers.parse_number(pick("위도", "lat", "latitude")).alias("lat"), F.monotonically_increasing_id().alias("__at"))
    from pyspark.sql import Window

    # a scan numbers rows by partition, so only the partitions' counts meet in one task
    rows = cut(rows.withColumn("__part", F.shiftright("__at", 33)))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(before, F.lit(0)).alias("__off"))
    number = F.col("__off") + F.row_number().over(Window.partitionBy("__part").orderBy("__at"))
    return rows.join(F.broadcast(offsets), "__part").withColumn("facility_id", F.format_string("F%06d", number)).drop("__at", "__part", "__off")


def land_price_snapshots(df: DataFrame) -> DataFrame:
    """SRC-13: (cell_x, cell_y, snapshot_date, value) of columns p_YYYYMMDD; cells that occur twice stop the job."""
    prices = [c for c in df.columns if c.startswith("p_") and c[2:].isdigit()]
    w_count: Column = F.count("*")
    twice = df.groupBy("cell_x", "cell_y").agg(w_count.alias("n")).where("n > 1").limit(1).count()
    if twice:
        raise ValueError("a cell occurs more than once")
    long = df.select("cell_x", "cell_y", *[F.col(c).cast("double") for c in prices]).unpivot(["cell_x", "cell_y"], prices, "snapshot", "value")
    return long.select("cell_x", "cell_y", F.to_date(F.substring("snapshot", 3, 8), "yyyyMMdd").alias("snapshot_date"), "value").where("value is not null")


def read_parquet_without(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """SRC-08: a Parquet scan of all columns but some; the scan reads no more than later steps use."""
    return spark.read.parquet(path).drop(*columns)
