"""Rows made narrow for sorts and shuffles, without a change of their order."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Bits of a column in a word. Spark spends 64 on each, whatever it holds.
_BITS = {"bigint": 16, "boolean": 2}
_WORD = 64
_LEAST = 8  # neighbouring columns that are worth it
_SIGN = -(1 << 63)  # flipped, it makes words compare as if they had no sign


class Packing:
    """Neighbouring bigint and boolean columns of a schema as words of 64 bits.

    The words stand where the columns stood. Rows sorted by all columns, ascending with NULLs last, have the same
    order by all packed columns. Nothing is assumed of the values: a number below 0 or beyond its bits keeps its whole
    row of them beside the words, which then say no more than what lies before it. ``keep`` names columns to be left as they are.
    """

    def __init__(self, schema: StructType, keep: Collection[str] = ()):
        self.schema = schema
        runs: list[list[StructField]] = [[]]
        for field in schema.fields:
            if field.dataType.simpleString() not in _BITS or field.name in keep:
                runs.append([])
            else:
                runs[-1].append(field)
        self.runs = [_Run(f"_packed{i}", run) for i, run in enumerate(r for r in runs if len(r) >= _LEAST)]

    def pack(self, df: DataFrame) -> DataFrame:
        df = df.select(*self.schema.names, *[run.first_outside().alias(run.first) for run in self.runs])
        of = {name: run for run in self.runs for name in run.names}
        columns: list[str | Column] = []
        for name in self.schema.names:
            if name not in of:
                columns.append(name)
            elif name == of[name].names[0]:
                columns += of[name].packed()
        return df.select(*columns)

    def unpack(self, df: DataFrame) -> DataFrame:
        values = {name: column for run in self.runs for name, column in run.unpacked().items()}
        return df.select(*[values.get(name, name) for name in self.schema.names])


class _Run:
    """Codes of a column: 0 below its bits, value + 1, then beyond its bits, then NULL, which is all ones."""

    def __init__(self, label: str, fields: list[StructField]):
        self.names = [f.name for f in fields]
        self.kinds = [f.dataType.simpleString() for f in fields]
        self.first, self.whole = f"{label}_first", f"{label}_whole"
        self.words: list[str] = []
        self.places: list[tuple[str, int, int]] = []  # word, shift, code of NULL
        left = 0
        for kind in self.kinds:
            if left < _BITS[kind]:
                self.words.append(f"{label}_{len(self.words)}")
                left = _WORD
            left -= _BITS[kind]
            self.places.append((self.words[-1], left, (1 << _BITS[kind]) - 1))

    def first_outside(self) -> Column:
        """Place of the first number that has no code; behind the last column if all have one."""
        place = F
        for i, (name, kind, (_, _, none)) in enumerate(zip(self.names, self.kinds, self.places)):
            if kind == "bigint":
                place = place.when((F.col(name) < 0) | (F.col(name) > none - 3), i)
        return F.lit(len(self.names)) if place is F else place.otherwise(len(self.names))

    def packed(self) -> list[Column]:
        first = F.col(self.first)
        words = dict.fromkeys(self.words, F.lit(_SIGN))
        for i, (name, (word, shift, none)) in enumerate(zip(self.names, self.places)):
            value = F.col(name).cast("bigint")
            code = (F.when(first < i, 0).when(value.isNull(), none).when(value < 0, 0).when(value > none - 3, none - 1)
                    if none > 3 else F.when(first < i, 0).when(value.isNull(), none))
            words[word] = words[word].bitwiseXOR(F.shiftleft(code.otherwise(value + 1).cast("bigint"), shift))
        whole = F.array(*[F.struct(F.col(n).isNull().alias("missing"), F.col(n).cast("bigint").alias("value")) for n in self.names])
        return [*[column.alias(word) for word, column in words.items()],
                F.when(first < len(self.names), whole).alias(self.whole)]

    def unpacked(self) -> dict[str, Column]:
        out = {}
        for i, (name, kind, (word, shift, none)) in enumerate(zip(self.names, self.kinds, self.places)):
            code = F.shiftrightunsigned(F.col(word).bitwiseXOR(F.lit(_SIGN)), shift).bitwiseAND(F.lit(none))
            value = F.when(F.col(self.whole).isNotNull(), F.get(self.whole, F.lit(i))["value"]).when(code != none, code - 1)
            out[name] = value.cast(kind).alias(name)
        return out
