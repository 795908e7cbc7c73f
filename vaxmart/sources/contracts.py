"""Source contracts as JSON documents: a stream's columns, types, nullability and column selection.

The document lists ``streams``; each has an id, a JSON schema with ``properties`` (the type of a column is a name or a
list of names, in which ``null`` makes it nullable; ``format`` refines strings) and, optionally, ``metadata`` entries
whose breadcrumb names a column and which select it or not.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vaxmart.operators import quality

# Fixed values of the format: its types, refined by format.
_TYPES = {("string", None): T.StringType(), ("string", "date"): T.DateType(), ("string", "date-time"): T.TimestampType(),
          ("integer", None): T.IntegerType(), ("number", None): T.DoubleType(), ("boolean", None): T.BooleanType()}


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    stream: str
    schema: T.StructType
    keys: tuple[str, ...]
    closed: bool  # no other columns allowed

    @property
    def types(self) -> dict[str, str]:
        names = {"int": "integer"}
        return {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in self.schema.fields}

    @property
    def nullable(self) -> set[str]:
        return {f.name for f in self.schema.fields if f.nullable}

    def report(self, df: DataFrame) -> DataFrame:
        """One row per contract column and per extra column (see ``quality.contract_report``)."""
        return quality.contract_report(df, self.types, self.nullable)

    def conform(self, df: DataFrame) -> DataFrame:
        """The selected columns in contract order; raises on missing or mistyped ones."""
        return quality.conform_to_contract(df, self.types)


def parse_contract(document: str, stream: str) -> Contract:
    """The contract of one stream; columns whose metadata selects them not are left out."""
    try:
        streams = json.loads(document)["streams"]
    except (ValueError, KeyError, TypeError) as e:
        raise ContractError(f"not a contract document: {e}") from e
    entry = next((s for s in streams if stream in (s.get("tap_stream_id"), s.get("stream"))), None)
    if entry is None:
        raise ContractError(f"no stream {stream}")
    dropped = {m["breadcrumb"][1] for m in entry.get("metadata", [])
               if len(m.get("breadcrumb", [])) == 2 and not m.get("metadata", {}).get("selected", True)}
    fields = []
    for name, spec in entry["schema"]["properties"].items():
        kinds = [spec["type"]] if isinstance(spec.get("type"), str) else list(spec.get("type") or [])
        base = [k for k in kinds if k != "null"]
        kind = _TYPES.get((base[0], spec.get("format")), _TYPES.get((base[0], None))) if len(base) == 1 else None
        if kind is None:
            raise ContractError(f"{stream}.{name}: type {kinds} is not supported")
        if name not in dropped:
            fields.append(T.StructField(name, kind, "null" in kinds))
    keys = tuple(entry.get("key_properties") or ())
    return Contract(stream, T.StructType(fields), keys, entry["schema"].get("additionalProperties") is False)


def read_contract(spark: SparkSession, path: str, stream: str) -> Contract:
    """The contract in a file that Spark can read (one small document)."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise ContractError(f"{path} is empty")
    return parse_contract(row["value"], stream)


def contract_document(stream: str, types: dict[str, str], nullable: set[str], dropped: tuple[str, ...] = ()) -> str:
    """The document for given columns (``integer``, ``string`` and so on), for sources that have none."""
    properties = {c: {"type": ["null", t] if c in nullable else [t]} for c, t in types.items()}
    metadata = [{"breadcrumb": [], "metadata": {"selected": True}}]
    metadata += [{"breadcrumb": ["properties", c], "metadata": {"selected": c not in dropped}} for c in types]
    return json.dumps({"streams": [{"tap_stream_id": stream, "stream": stream, "key_properties": [], "metadata": metadata, "schema": {
        "type": ["null", "object"], "additionalProperties": False, "properties": properties}}]})
