"""Line patches of lists: RCS-style blocks, their parser, application and checksums."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT = T.StringType()
COMMAND = _struct(op=TEXT, n=T.IntegerType(), c=T.IntegerType(), payload=T.ArrayType(TEXT))
BLOCK = _struct(name=TEXT, checksum=TEXT, commands=T.ArrayType(COMMAND))


class PatchError(ValueError):
    """A patch that can't be read or applied."""


def parse(text: str) -> list[dict]:
    """Blocks of a patch. A block starts at a line `diff key:value ...`; text before the first is ignored."""
    blocks: list[dict] = []
    lines = iter(text.splitlines(keepends=True))
    for line in lines:
        words = line.split()
        if line.strip()[:5].lower() == "diff ":
            said = dict((k.lower(), v) for k, found, v in (w.partition(":") for w in words[1:]) if found)
            blocks.append({"name": said.get("name"), "checksum": said.get("checksum"), "commands": []})
        elif words and blocks and not words[0].startswith((";", "#")):
            blocks[-1]["commands"].append(_command(line.strip(), lines))
    return blocks


def _command(said: str, lines) -> dict:
    op, numbers = said[0].lower(), said[1:].split()
    try:
        n, c = map(int, numbers)
    except ValueError:
        raise PatchError(f"not a command: {said}") from None
    if op not in "ad":
        raise PatchError(f"not a command: {said}")
    payload = [x for _, x in zip(range(c), lines, strict=False)] if op == "a" else []
    if op == "a" and len(payload) < c:
        raise PatchError("the patch ends within an addition")
    return {"op": op, "n": n, "c": c, "payload": payload}


@F.pandas_udf(_struct(blocks=T.ArrayType(BLOCK), error=TEXT))
def parsed(patches: pd.Series) -> pd.DataFrame:
    """Blocks of each patch, or what is wrong with it."""
    out = []
    for text in patches:
        try:
            out.append((None if text is None else parse(text), None))
        except PatchError as e:
            out.append((None, str(e)))
    return pd.DataFrame(out, columns=["blocks", "error"])


def lines_of(text: Column) -> Column:
    """The lines of a text with their ends, cut where patches cut them."""
    cut = F.split(text, r"(?<=\r\n)|(?<=\r)(?!\n)|(?<=[\n\x0b\x0c\x1c\x1d\x1e\x85  ])")
    return F.filter(cut, lambda x: x != "")


def apply(lines: Column, commands: Column) -> Column:
    """The lines after all commands, each on what the ones before left; null if one is out of range."""

    def step(state: Column, k: Column) -> Column:
        n, c, size = k["n"], k["c"], F.size(state)
        delete = F.concat(F.slice(state, F.lit(1), n - 1), F.slice(state, n + c, F.greatest(size - n - c + 1, F.lit(0))))
        add = F.concat(F.slice(state, F.lit(1), n), k["payload"], F.slice(state, n + 1, F.greatest(size - n, F.lit(0))))
        can_delete = (k["op"] == "d") & (c >= 0) & (n >= 1) & (n - 1 + c <= size)
        can_add = (k["op"] == "a") & (c >= 0) & (n >= 0) & (n <= size)
        return F.when(state.isNotNull() & can_delete, delete).when(state.isNotNull() & can_add, add)

    return F.aggregate(commands, lines, step)


def chosen(blocks: Column, resource: Column) -> Column:
    """The first block of that name, or the first of all without a name."""
    named = F.get(F.filter(blocks, lambda b: b["name"] == resource), F.lit(0))
    return F.when(F.coalesce(resource, F.lit("")) == "", F.get(blocks, F.lit(0))).otherwise(named)


def patched(rows: DataFrame) -> DataFrame:
    """rows: text, patch, resource. Adds result (null if it fails) and error."""
    found = rows.withColumn("_p", parsed("patch")).withColumn("_b", chosen(F.col("_p.blocks"), F.col("resource")))
    found = found.withColumn("_r", F.array_join(apply(lines_of(F.col("text")), F.col("_b.commands")), ""))
    wanted = F.col("_b.checksum")
    fits = F.coalesce(wanted == "", F.lit(True)) | (F.lower(wanted) == F.sha1(F.col("_r").cast("binary")))
    error = (
        F.when(F.col("_p.error").isNotNull(), F.col("_p.error"))
        .when(F.size("_p.blocks") == 0, "no blocks")
        .when(F.col("_b").isNull(), "no block of that name")
        .when(F.col("_r").isNull(), "out of range")
        .when(~fits, "checksum differs")
    )
    return found.withColumn("error", error).withColumn("result", F.when(F.col("error").isNull(), F.col("_r"))).drop("_p", "_b", "_r")
