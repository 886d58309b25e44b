"""What the operators of this subpackage share: tables, stored intermediate results, ASCII folding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from trendengine.session import remove_folder, scratch_path

#: Rows whose results a Python worker holds before it hands them back.
ROWS_AT_ONCE = 1000
#: A-Z to a-z, every other byte as it is: UTF-8 text can be folded without decoding it.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where each table made by `stored` lies.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cut lineage that outlives lost executors."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    _paths[found] = path
    return found


def remove_stored(spark: SparkSession, df: DataFrame) -> None:
    """Delete the folder of a table made by ``stored`` that nothing reads any more."""
    remove_folder(spark, _paths.pop(df))


def utf8(column) -> list[bytes | None]:
    """The values of an Arrow string column as UTF-8."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def with_column(docs: DataFrame, inputs: list[str], name: str, kind: str, make) -> DataFrame:
    """``docs`` and one more column made in Python, Arrow batch by Arrow batch, next to all that it has.

    ``make()`` is called once per task and gives a function from a list of Arrow columns to a list of values. Where ``docs``
    already has a column ``name``, the new one is the last; ask `fresh` for a name to avoid that.
    """
    from pyspark.sql.types import StructType

    schema = StructType(list(docs.schema.fields)).add(name, kind)
    at = [docs.columns.index(c) for c in inputs]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        arrow, work = to_arrow_type(schema[-1].dataType), make()
        for batch in batches:
            for part in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = batch.slice(part, ROWS_AT_ONCE)
                values = work([rows.column(i) for i in at])
                values = values.cast(arrow) if isinstance(values, pa.Array) else pa.array(values, arrow)
                yield pa.RecordBatch.from_arrays([*rows.columns, values], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, longer by underscores while ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def any_columns(*used: str):
    """For functions from a table to a table with all its columns: lets these have any name and type.

    The columns named in ``used`` keep their names, the others get plain ones while the function runs, so dots, blanks and names that the
    function makes for itself do no harm. What it adds gets underscores if the table has that name.
    """

    def around(function):
        @wraps(function)
        def run(*args, **named):
            at = next(i for i, x in enumerate(args) if isinstance(x, DataFrame))
            docs = args[at]
            inside = [c if c.lower() in used else f"column_{i}_" for i, c in enumerate(docs.columns)]
            out = function(*args[:at], docs.toDF(*inside), *args[at + 1 :], **named)
            outside, names = dict(zip(inside, docs.columns)), []
            for c in out.columns:
                name = outside.get(c, c)
                while c not in outside and name.lower() in {x.lower() for x in docs.columns}:
                    name += "_"
                names.append(name)
            return out.toDF(*names)

        return run

    return around
