"""Table configuration: which columns, keys and types a loaded table has."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

# Config type -> SQL type of the stored column.
SQL_TYPES = {
    "date": "DATE",
    "datetime": "TIMESTAMP_NTZ",
    "boolean": "BOOLEAN",
    "int": "INT",
    "long": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "STRING",
    "clob": "STRING",
    "blob": "STRING",
}


@dataclass(frozen=True)
class Column:
    columnid: int
    name: str
    type: str
    primary_key: bool = False


def parse_overrides(text: str) -> dict[str, str]:
    """``"a=INT,b=DECIMAL(10,2)"`` -> ``{"a": "INT", "b": "DECIMAL(10,2)"}``."""
    pairs = re.findall(r"([^=,\s]+)\s*=\s*([^,(]+(?:\([^)]*\))?)", text or "")
    return {name: sql_type.strip() for name, sql_type in pairs}


@dataclass(frozen=True)
class TableConfig:
    columns: tuple[Column, ...]
    keys: tuple[str, ...] = ()
    url: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    database: str = ""
    table: str = ""
    hive_db: str = ""
    hive_table: str = ""
    split_by: str = ""
    import_type: str = "inc"
    use_chain: bool = True
    overrides: Mapping[str, str] = field(default_factory=dict)
    source_root: str = ""
    category_input: str = ""
    category_output: str = ""
    path_db: str = ""
    path_table: str = ""
    schema_version: str = ""

    @classmethod
    def from_json(cls, text: str) -> "TableConfig":
        raw = json.loads(text)
        columns = tuple(
            Column(
                int(c["columnid"]),
                c["name"],
                c["type"],
                str(c.get("primary_key", "false")).lower() == "true",
            )
            for c in raw["columns"]
        )
        keys = tuple(k.strip() for k in raw.get("db.table_keys", "").split(",") if k.strip())
        return cls(
            columns=columns,
            keys=keys,
            url=raw.get("db.url", ""),
            user=raw.get("db.username", ""),
            password=raw.get("db.password", ""),
            database=raw.get("db.database", ""),
            table=raw.get("db.table_name", ""),
            hive_db=raw.get("hive_db", ""),
            hive_table=raw.get("hive_table", ""),
            split_by=raw.get("sqoop.split-by", ""),
            import_type=raw.get("sqoop.import-type", "inc"),
            use_chain=str(raw.get("usechain", "true")).lower() == "true",
            overrides=parse_overrides(raw.get("sqoop.map-column-hive", "")),
            source_root=raw.get("hdfs.root", ""),
            category_input=raw.get("hdfs.category.input", ""),
            category_output=raw.get("hdfs.category.output", ""),
            path_db=raw.get("hdfs.db_name", ""),
            path_table=raw.get("hdfs.table_name", ""),
            schema_version=raw.get("hdfs.schema_version", ""),
        )

    @property
    def ordered(self) -> tuple[Column, ...]:
        if not self.columns:
            raise ValueError(f"table {self.hive_table or self.table!r} declares no columns")
        return tuple(sorted(self.columns, key=lambda c: c.columnid))

    @property
    def dialect(self) -> str:
        """``mysql`` for ``jdbc:mysql://...``; empty when there is no database."""
        parts = self.url.split(":")
        return parts[1].lower() if parts[0] == "jdbc" and len(parts) > 1 else ""

    @property
    def key_names(self) -> list[str]:
        """Key columns in column order; names match without regard to case."""
        declared = {k.upper() for k in self.keys}
        return [c.name for c in self.ordered if c.name.upper() in declared or (not declared and c.primary_key)]

    def sql_type(self, column: Column, binary_blob: bool = False) -> str:
        override = self.overrides.get(column.name)
        if override:
            return override
        kind = column.type.lower()
        if kind == "blob" and binary_blob:
            return "BINARY"
        if re.fullmatch(r"decimal\(\s*\d+\s*,\s*\d+\s*\)", kind):
            return kind.upper()
        if kind not in SQL_TYPES:
            raise ValueError(f"column {column.name!r}: no SQL type for {column.type!r}; add an override")
        return SQL_TYPES[kind]

    def run_path(self, category: str, *parts: str) -> str:
        base = [self.source_root, category, self.path_db, self.path_table, self.schema_version]
        return "/".join([p.rstrip("/") for p in base] + list(parts))
