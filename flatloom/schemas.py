"""Document and table layouts, declared once and used by every reader, plan and check."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


_TYPES = {
    "boolean": BooleanType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


@dataclass(frozen=True)
class Dimension:
    """A table of attributes that every entry repeats: key plus {table column: entry column}."""

    table: str
    key: str
    attributes: dict[str, str]


@dataclass(frozen=True)
class Reference:
    """Foreign key ``table.column -> parent.parent_column``."""

    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class DocumentModel:
    """How a document with an array of parents, each with an array of entries, maps to tables.

    A parent too long for one document may go on in later ones: such a continuation
    repeats the key, counts up ``part`` from 1 and has no other attributes.
    """

    schema: StructType
    parents: str
    entries: str
    parent_table: str
    parent_key: str
    fact_table: str
    fact_columns: tuple[str, ...]
    dimensions: tuple[Dimension, ...]
    flags: tuple[str, ...] = ()
    epochs: tuple[str, ...] = ()
    part: str | None = None
    nullable: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    fact_key: tuple[str, ...] = field(default=())

    @property
    def parent_schema(self) -> StructType:
        return self.schema[self.parents].dataType.elementType

    @property
    def entry_schema(self) -> StructType:
        return self.parent_schema[self.entries].dataType.elementType

    @property
    def parent_columns(self) -> list[str]:
        skipped = {self.entries, self.part}
        return [f.name for f in self.parent_schema if f.name not in skipped]

    @property
    def entry_columns(self) -> list[str]:
        return [f.name for f in self.entry_schema]

    @property
    def tables(self) -> list[str]:
        return [d.table for d in self.dimensions] + [self.parent_table, self.fact_table]

    def keys(self) -> dict[str, tuple[str, ...]]:
        """Primary key of every table."""
        keys = {d.table: (d.key,) for d in self.dimensions}
        return keys | {self.parent_table: (self.parent_key,), self.fact_table: self.fact_key}

    def pruned(self, parent_fields: Iterable[str], entry_fields: Iterable[str] | None) -> StructType:
        """The document schema narrowed to the named fields.

        A text reader converts only what its schema names, so naming fewer fields is
        the column pruning that Catalyst cannot do inside JSON. ``entry_fields=None``
        leaves the entry array out.
        """
        wanted = set(parent_fields)
        fields = [f for f in self.parent_schema if f.name in wanted or f.name == self.part]
        if entry_fields is not None:
            chosen = set(entry_fields)
            entry = StructType([f for f in self.entry_schema if f.name in chosen])
            fields.append(StructField(self.entries, ArrayType(entry)))
        return StructType([StructField(self.parents, ArrayType(StructType(fields)))])

    def table_schema(self, table: str) -> StructType:
        """Columns of one target table, in the order they are written."""
        entry = {f.name: f.dataType for f in self.entry_schema}
        for dim in self.dimensions:
            if dim.table == table:
                names = {dim.key: dim.key} | dim.attributes
                return StructType([StructField(out, entry[src]) for out, src in names.items()])
        if table == self.fact_table:
            key = self.parent_schema[self.parent_key].dataType
            return StructType(
                [StructField(c, key if c == self.parent_key else entry[c]) for c in self.fact_columns]
            )
        if table == self.parent_table:
            return StructType([self._parent_field(name) for name in self.parent_columns])
        raise KeyError(table)

    def _parent_field(self, name: str) -> StructField:
        if name in self.flags:
            return StructField(name, BooleanType())
        if name in self.epochs:
            return StructField(name, TimestampType())
        return StructField(name, self.parent_schema[name].dataType)

    def required(self, table: str) -> list[str]:
        """Columns of a table that must not be NULL."""
        optional = set(self.nullable) if table == self.parent_table else set()
        return [f.name for f in self.table_schema(table) if f.name not in optional]


def struct_of(columns: str, *extra: StructField) -> StructType:
    """``"a int, b string"`` as a StructType; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[dtype]) for name, dtype in pairs] + list(extra))


# The field names and types of the input documents.
TRACK = struct_of(
    "pos int, track_uri string, track_name string, duration_ms int, "
    "album_uri string, album_name string, artist_uri string, artist_name string"
)
PLAYLIST = struct_of(
    "pid int, name string, description string, collaborative string, modified_at long, "
    "num_tracks int, num_albums int, num_artists int, num_followers int, num_edits int, "
    "duration_ms long",
    StructField("tracks", ArrayType(TRACK)),
)

# The five target tables, their keys and what they refer to.
PLAYLISTS = DocumentModel(
    schema=StructType([StructField("playlists", ArrayType(PLAYLIST))]),
    parents="playlists",
    entries="tracks",
    parent_table="playlists",
    parent_key="pid",
    fact_table="playlist_tracks",
    fact_columns=("pid", "pos", "track_uri"),
    fact_key=("pid", "pos"),
    dimensions=(
        Dimension("artists", "artist_uri", {"name": "artist_name"}),
        Dimension("albums", "album_uri", {"name": "album_name", "artist_uri": "artist_uri"}),
        Dimension(
            "tracks",
            "track_uri",
            {"name": "track_name", "album_uri": "album_uri", "duration_ms": "duration_ms"},
        ),
    ),
    flags=("collaborative",),
    epochs=("modified_at",),
    nullable=("description",),
    references=(
        Reference("albums", "artist_uri", "artists", "artist_uri"),
        Reference("tracks", "album_uri", "albums", "album_uri"),
        Reference("playlist_tracks", "pid", "playlists", "pid"),
        Reference("playlist_tracks", "track_uri", "tracks", "track_uri"),
    ),
)

# The columns of a run-result file, in file order.
RUN_RESULT = struct_of(
    "run_at string, loader string, slices int, load_s double, constraints_s double, "
    "total_s double, rows_per_s long, status string, artists long, albums long, "
    "tracks long, playlists long, playlist_tracks long, rep int"
)
