"""Delimited-text scans.

Raw tables are read with every column as ``string``: types are decided at cleaning time,
never guessed per split. Each scan can attach ``_ord``, a sortable struct that restores
file order (file path, split start, row id within the split). It is built on the scan
itself, before any shuffle, and is persisted into the raw Parquet so later "first" and
"last" decisions are deterministic regardless of the number of splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from cauce.functions.text import NA_WORDS, null_markers
from cauce.operators.joins import broadcast_if_small, left_join
from cauce.session import checkpoint_root

ORD = "_ord"
_ENCODING_ALIASES = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "iso8859-1": "ISO-8859-1"}
# A control character that does not occur in text, so a CSV scan keeps each line whole.
_LINE_SEP = "\u0001"


def _encoding(name: str) -> str:
    return _ENCODING_ALIASES.get(name.lower(), name)


def order_column() -> Column:
    """``_ord``: file path, split start, then a row id that increases within a split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Header names made unique: the first occurrence keeps its name, later ones get
    ``.1``, ``.2`` ... (names are compared without case, as Spark does; so a duplicated ``2019`` header still matches a 4-digit rule once).
    Empty names become ``Unnamed: <i>``."""
    seen: dict[str, int] = {}
    out = []
    for i, raw in enumerate(names):
        name = raw if raw not in ("", None) else f"Unnamed: {i}"
        base = name
        while name.casefold() in seen:
            seen[base.casefold()] += 1
            name = f"{base}.{seen[base.casefold()]}"
        seen.setdefault(name.casefold(), 0)
        out.append(name)
    return out


def split_header(line: str, sep: str) -> list[str]:
    """Split a header line on ``sep`` honouring double quotes (doubled quote = literal)."""
    fields, cur, quoted, i = [], [], False, 0
    while i < len(line):
        ch = line[i]
        if quoted:
            if ch == '"' and i + 1 < len(line) and line[i + 1] == '"':
                cur.append('"')
                i += 1
            elif ch == '"':
                quoted = False
            else:
                cur.append(ch)
        elif ch == '"':
            quoted = True
        elif line.startswith(sep, i):
            fields.append("".join(cur))
            cur = []
            i += len(sep) - 1
        else:
            cur.append(ch)
        i += 1
    fields.append("".join(cur))
    return [f.strip("\r") for f in fields]


def united_columns(headers: Sequence[str], sep: str) -> tuple[list[str], list[list[int]]]:
    """The columns of several header lines, in order of appearance, and for each line the place of
    every column in it (-1: absent). Names are compared without case, outer blanks and a byte order
    mark, the k-th of equal names with the k-th; a column is shown as the first line that has it writes it."""
    shown: list[str] = []
    known: dict[str, int] = {}
    found: list[dict[int, int]] = []
    for line in headers:
        fields = split_header(line, sep)
        keys = dedupe_names([f.strip("\ufeff").strip() for f in fields])
        at = {}
        for i, (key, name) in enumerate(zip(keys, dedupe_names(fields))):
            if key.casefold() not in known:
                known[key.casefold()] = len(shown)
                shown.append(name)
            at[known[key.casefold()]] = i
        found.append(at)
    return dedupe_names(shown), [[at.get(j, -1) for j in range(len(shown))] for at in found]


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Every physical line of the files as ``value`` (decoded with ``encoding``), blank ones too, plus
    ``_ord``. Lines are read as bytes and decoded. Encodings that Spark's ``decode`` doesn't take go
    through a CSV scan, which leaves blank lines out and ends a line at U+0001."""
    name = _encoding(encoding)
    if name.upper() in ("ISO-8859-1", "UTF-8", "US-ASCII"):
        text = F.decode(F.col("value").cast("binary"), name)
        if name.upper() == "UTF-8":
            text = F.when(text.startswith("\ufeff"), F.substring(text, 2, 1 << 30)).otherwise(text)
        return spark.read.text(path).select(text.alias("value"), order_column().alias(ORD))
    df = (
        spark.read.option("sep", _LINE_SEP)
        .option("quote", "")
        .option("encoding", name)
        .option("header", "false")
        .schema("value string")
        .csv(path)
    )
    return df.select("value", order_column().alias(ORD))


def join_quoted_lines(lines: DataFrame) -> DataFrame:
    """Lines (``value``, ``_ord``) as records: a line break between quotes belongs to the value (and
    reads as ``\\n``). A record keeps its first line's ``_ord``.

    A line with an odd number of quotes opens or closes a value. One aggregate sums them per input split;
    if there are none, the lines are returned as they are. Otherwise a running sum over the splits of a
    file gives each split's state at its start, windows over single splits give every line's, and
    only the lines of records that span several are shuffled together.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    marked = lines.select(
        "value", F.col(f"{ORD}.file").alias("file"), F.col(f"{ORD}.block").alias("block"), F.col(f"{ORD}.row").alias("row"),
        (quotes % 2).cast("int").alias("odd"),
    )
    if marked.where("odd = 1").limit(1).isEmpty():
        return lines
    place = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(*place).agg(F.sum("odd").alias("n"))
    base = sums.select(*place, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2).alias("base"))  # a row for each split
    before = Window.partitionBy(*place).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*place).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    state = (F.col("base") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2
    known = marked.join(base, place).withColumn("first", state == 0)
    known = known.withColumn("start", F.max(F.when(F.col("first"), F.col("row"))).over(upto))
    last = known.groupBy(*place).agg(F.max("start").alias("row"))
    held = F.last(F.when(F.col("row").isNotNull(), F.struct("block", "row")), ignorenulls=True).over(earlier)
    carried = last.select(*place, held.alias("carried"))  # the record that runs into the split
    known = known.join(carried, place, "left")
    here = F.struct("block", F.col("start").alias("row"))
    known = known.withColumn("record", F.when(F.col("start").isNotNull(), here).otherwise(F.col("carried")))
    whole = F.col("first") & (F.col("odd") == 0)
    alone = known.where(whole).select("value", F.struct("file", "block", "row").alias(ORD))
    parts = known.where(~whole).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("parts")
    )
    spanning = parts.select(
        F.array_join(F.col("parts.value"), "\n").alias("value"),
        F.struct("file", F.col("record.block").alias("block"), F.col("record.row").alias("row")).alias(ORD),
    )
    return alone.unionByName(spanning)


def _apply_na(df: DataFrame, names: Sequence[str], na_words: bool) -> DataFrame:
    if not na_words:
        return df
    return df.select(*[null_markers(F.col(f"`{n}`")).alias(n) if n in names else F.col(f"`{n}`")
                       for n in df.columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = True,
    with_order: bool = True,
    na_words: bool = True,
    multiline: bool = False,
    check_headers: bool = False,
    by_name: bool | None = None,
) -> DataFrame:
    """Delimited text, all columns ``string``, header names de-duplicated. Every file
    starts with a header line (Spark drops it from each file); the names are read
    from one line of one split, and the scan itself fails on a file with other names or another order.

    It can't where names had to be changed (repeated, empty, with outer blanks). Then every file's
    header is read first (one extra pass over the files: Spark cannot prune a scan to first
    splits), and if they differ each file is read by its own names (``parse_lines`` with ``by_name``).
    ``by_name=True`` does so for all names, ``False`` for none (files are taken to start alike);
    ``check_headers`` raises if headers differ.

    ``na_words`` turns the reader's usual missing-value words into null (X15).
    ``multiline`` allows quoted line breaks but makes each file one split.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("encoding", _encoding(encoding))
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(multiline).lower())
        .option("mode", "PERMISSIVE")
    )
    if header:
        # the first line of a first split: an incremental limit reads one split only
        first = (
            read_lines(spark, path, encoding)
            .where((F.col(f"{ORD}.block") == 0) & (F.col("value") != ""))
            .select("value")
            .limit(1)
            .collect()
        )
        first = first[0] if first else None
        if first is None:
            return spark.createDataFrame([], "`_empty` string")
        found = split_header(first[0], sep)
        names = dedupe_names(found)
        # names taken as they stand: the scan itself fails on a file with other ones
        as_read = names == found and all(n == n.strip().strip("\ufeff") for n in names)
        if by_name is None:
            by_name = not as_read
        if check_headers or by_name:
            lines = read_lines(spark, path, encoding)
            tops = _distinct_headers(header_table(lines, None, sep))
            differing = [r["file"] for r in tops if dedupe_names(split_header(r["header"], sep)) != names]
            if differing and check_headers:
                raise ValueError(f"file(s) start with another header, e.g. {differing[0]}")
            if differing:
                df = parse_lines(lines, None, sep, na_words=na_words, quoted_breaks=multiline, by_name=True)
                return df if with_order else df.drop(ORD)
        df = reader.option("header", "true").option("enforceSchema", str(not as_read).lower()).schema(
            _string_schema(names)
        ).csv(path)
    else:
        df = reader.option("header", "false").csv(path)
        names = df.columns
    cols = [F.col(f"`{n}`") for n in names]
    if with_order:
        cols.append(order_column().alias(ORD))
    return _apply_na(df.select(*cols), names, na_words)


def header_table(lines: DataFrame, token: str | None, sep: str = ";", max_scan: int = 300) -> DataFrame:
    """Per file of a line scan (``value``, ``_ord``): the first of its first ``max_scan``
    lines containing ``token`` and ``sep``, else the file's first line with any text
    (``token=None``: always that). One row per file: ``file``, ``header_index`` (0-based among all
    physical lines), ``header``, ``header_ord`` and ``found`` (false where the first line stands in).

    Only first-split lines are ranked, and the ``row_number() <= max_scan`` filter becomes
    a partial window-group limit before the exchange, so the shuffle carries at most
    ``max_scan`` lines per file.
    """
    first_split = lines.where(F.col(f"{ORD}.block") == 0).withColumn("file", F.col(f"{ORD}.file"))
    head = (
        first_split.withColumn("rn", F.row_number().over(_file_window()))
        .where(F.col("rn") <= max_scan)
        .withColumn("idx", F.col("rn") - 1)
    )
    if token is None:
        hit = F.col("value") != ""
    else:
        hit = F.col("value").contains(token) & F.col("value").contains(sep)
    # the line sought, else the first with any text, else the first
    rank = F.struct(F.when(hit, 0).when(F.col("value") != "", 1).otherwise(2).alias("kind"), "idx")
    best = head.groupBy("file").agg(F.min_by(F.struct("idx", "value", ORD, hit.alias("hit")), rank).alias("best"))
    return best.select(
        "file", F.col("best.idx").alias("header_index"), F.col("best.value").alias("header"),
        F.col(f"best.{ORD}").alias("header_ord"), F.col("best.hit").alias("found"),
    )


def locate_header(
    spark: SparkSession,
    path: str | Sequence[str],
    token: str = "Municipio",
    sep: str = ";",
    max_scan: int = 300,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """Per file, the header line (see ``header_table``)."""
    return header_table(read_lines(spark, path, encoding), token, sep, max_scan)


def _file_window():
    return Window.partitionBy("file").orderBy(ORD)


def _distinct_headers(headers: DataFrame, max_headers: int = 10_000) -> list:
    """The different header lines of a header table, by first file (``header``, ``file``): one partial
    aggregate. They decide the schema, so more than ``max_headers`` of them are an error."""
    first = headers.groupBy("header").agg(F.min_by("file", "header_ord").alias("file"), F.min("header_ord").alias("at"))
    rows = first.orderBy("at").limit(max_headers + 1).collect()
    if len(rows) > max_headers:
        raise ValueError(f"more than {max_headers} different header lines")
    return rows


def parse_lines(
    lines: DataFrame,
    token: str | None = "Municipio",
    sep: str = ";",
    max_scan: int = 300,
    na_words: bool = True,
    max_files: int = 100_000,
    quoted_breaks: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """Turn a line scan into a table: per file, lines above and including the header are
    dropped, the rest parsed with ``from_csv`` (quotes doubled as in the writer); short
    rows give nulls, extra fields are dropped, blank lines are none. ``quoted_breaks``: line breaks between
    quotes belong to the value (``join_quoted_lines``).

    All files must have the first file's columns in its order, unless ``by_name``: then each file is read by
    its own header, columns of one name are one (``united_columns``), and those that a file lacks are null.

    The header table has one row per file. Up to ``max_files`` rows it is collected and broadcast; a larger one is
    checkpointed, only the different header lines reach the driver, and the join is planned by its measured size.
    """
    spark = lines.sparkSession
    headers = header_table(lines, token, sep, max_scan)
    info = headers.orderBy("header_ord").limit(max_files + 1).collect()
    if not info:
        return spark.createDataFrame([], "`_empty` string")
    many = len(info) > max_files
    if many:
        checkpoint_root(spark)
        headers = headers.checkpoint()
        info = _distinct_headers(headers)
    columns = {r["header"]: dedupe_names(split_header(r["header"], sep)) for r in info}
    names = columns[info[0]["header"]]
    differing = [r["file"] for r in info if columns[r["header"]] != names]
    if differing and not by_name:
        raise ValueError(f"{len(differing)} file(s) have another header than {info[0]['file']}, e.g. {differing[0]}")
    places = None
    if differing:
        names, rows = united_columns(list(columns), sep)
        places = dict(zip(columns, rows))
    order = T.StructField("header_ord", lines.schema[ORD].dataType)
    if many:
        side = headers.select("file", "header_ord", "header")
        if places:
            known = spark.createDataFrame(list(places.items()), "header string, places array<int>")
            side = side.join(F.broadcast(known), "header")
        side, small = broadcast_if_small(side.drop("header"), persist=False)
    else:
        # the collected header rows (one per file) become the broadcast side: no second pass
        more = [T.StructField("places", T.ArrayType(T.IntegerType()))] if places else []
        rows = [(r["file"], r["header_ord"], *([places[r["header"]]] if places else [])) for r in info]
        side = F.broadcast(spark.createDataFrame(rows, T.StructType([T.StructField("file", T.StringType()), order, *more])))
        small = True
    how = "yes" if small else "no"
    body = left_join(lines.withColumn("file", F.col(f"{ORD}.file")), side.drop("places"), "file", broadcast=how)
    body = body.where(F.col(ORD) > F.col("header_ord")).select("value", ORD)
    if quoted_breaks:
        body = join_quoted_lines(body)
    body = body.where(F.col("value") != "")
    fields = names if places is None else [f"_c{i}" for i in range(max(map(len, columns.values())))]
    ddl = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in fields)
    parsed = F.from_csv("value", ddl, {"sep": sep, "escape": '"', "quote": '"'})
    if places is None:
        df = body.select(parsed.alias("r"), ORD).select(*[F.col("r").getField(n).alias(n) for n in names], ORD)
    else:
        body = left_join(body.withColumn("file", F.col(f"{ORD}.file")), side.select("file", "places"), "file", broadcast=how)
        read = body.select(parsed.alias("r"), "places", ORD)
        read = read.select(F.array(*[F.col("r").getField(n) for n in fields]).alias("r"), "places", ORD)
        df = read.select(*[F.get("r", F.col("places")[j]).alias(n) for j, n in enumerate(names)], ORD)
    return _apply_na(df, names, na_words)


def read_with_preamble(
    spark: SparkSession,
    path: str | Sequence[str],
    token: str = "Municipio",
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    max_scan: int = 300,
    na_words: bool = True,
    max_files: int = 100_000,
    quoted_breaks: bool = True,
    by_name: bool = False,
) -> DataFrame:
    """S3: skip everything above the header line of each file, then parse as S1. Quoted line breaks
    are looked for in one more pass over the files; ``quoted_breaks=False`` leaves it out. ``by_name``
    reads each file by its own header (``parse_lines``)."""
    lines = read_lines(spark, path, encoding)
    return parse_lines(lines, token, sep, max_scan, na_words, max_files, quoted_breaks, by_name)


def typed(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns as the narrowest type that holds all their values: whole numbers, numbers,
    ``True``/``False``, else text (a column without values: numbers, as pandas). One aggregate decides
    for all columns."""
    names = list(cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    trimmed = {n: F.trim(F.col("`" + n.replace("`", "``") + "`")) for n in names}
    number = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?|[+-]?(?i:inf|infinity)"
    tests = {
        "long": lambda c: c.rlike(r"^[+-]?[0-9]{1,19}$") & c.try_cast("long").isNotNull(),
        "double": lambda c: c.rlike(f"^({number})$"),
        "boolean": lambda c: c.isin("True", "False", "TRUE", "FALSE", "true", "false"),
    }
    if not names:
        return df
    row = df.agg(*[F.bool_and(test(trimmed[n])).alias(f"{kind}{i}") for i, n in enumerate(names) for kind, test in tests.items()]).first()
    out = []
    for name in df.columns:
        own = F.col("`" + name.replace("`", "``") + "`")
        if name in trimmed:
            i = names.index(name)
            kind = "double" if row[f"double{i}"] is None else next((k for k in tests if row[f"{k}{i}"]), None)
            own = trimmed[name].try_cast(kind).alias(name) if kind else own
        out.append(own)
    return df.select(*out)


def read_csv_default(
    spark: SparkSession, path: str, infer_types: bool = False, with_order: bool = False, na_words: bool = True,
    quoted_breaks: bool = True,
) -> DataFrame:
    """Comma-separated UTF-8 with header; a missing path raises ``FileNotFoundError``. The usual
    missing-value words are null (X15), quoted line breaks belong to their value.

    ``infer_types`` decides each column's type from all its values (``typed``, an extra pass over the
    data); the default keeps every column as text.
    """
    try:
        lines = read_lines(spark, path, "UTF-8")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"path does not exist: {path}") from exc
        raise
    df = parse_lines(lines, None, ",", na_words=na_words, quoted_breaks=quoted_breaks)
    if infer_types:
        df = typed(df, [c for c in df.columns if c != ORD])
    return df if with_order else df.drop(ORD)


def sniff_separator(
    spark: SparkSession,
    path: str,
    candidates: Sequence[str] = (";", ",", "\t"),
    encoding: str = "ISO-8859-1",
    sample_lines: int = 20,
) -> str | None:
    """First candidate that parts each of the first ``sample_lines`` lines (blank ones aside) into the
    same number of fields, more than one, quoted ones being whole; None when none qualifies."""
    lines = [r["value"] for r in preview_lines(spark, path, sample_lines, encoding).collect() if r["value"]]
    for sep in candidates:
        counts = {len(split_header(line, sep)) - 1 for line in lines}
        if lines and len(counts) == 1 and counts.pop() > 0:
            return sep
    return None


def read_sniffed(
    spark: SparkSession,
    path: str,
    candidates: Sequence[str] = (";", ",", "\t"),
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame | None, str | None]:
    """(DataFrame, separator) using the sniffed separator, or (None, None)."""
    sep = sniff_separator(spark, path, candidates, encoding)
    if sep is None:
        return None, None
    return read_delimited(spark, path, sep=sep, encoding=encoding), sep


def preview_lines(
    spark: SparkSession, path: str | Sequence[str], n: int = 20, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """The first ``n`` raw lines in file order (``line_no``, ``value``).

    A top-k on ``_ord``: each split keeps its first ``n`` lines, so the driver gets n rows.
    """
    lines = read_lines(spark, path, encoding).where(F.col(f"{ORD}.block") == 0)
    return (
        lines.orderBy(ORD)
        .limit(n)
        .select(
            F.row_number().over(_global_order()).alias("line_no"),
            "value",
        )
    )


def _global_order():
    # only ever applied to the n rows left after the top-k
    return Window.orderBy(ORD)


__all__ = [
    "NA_WORDS",
    "ORD",
    "dedupe_names",
    "header_table",
    "join_quoted_lines",
    "locate_header",
    "parse_lines",
    "order_column",
    "preview_lines",
    "read_csv_default",
    "read_delimited",
    "read_lines",
    "read_sniffed",
    "read_with_preamble",
    "sniff_separator",
    "split_header",
    "typed",
    "united_columns",
]
