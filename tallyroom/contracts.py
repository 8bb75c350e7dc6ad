"""Table contracts: columns, types, widths, keys and where each stage is stored.

A contract is plain data. The operators take column names, so nothing in the
library is tied to one subject area; the player contract at the end is the
instance the jobs use by default.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType(),
                "bigint": T.LongType(), "double": T.DoubleType()}
_JDBC_NAMES = {"string": "TEXT", "int": "INTEGER", "bigint": "BIGINT",
               "double": "DOUBLE PRECISION"}


@dataclass(frozen=True)
class Column:
    """One column: its stored type and, for text, the longest value allowed."""

    name: str
    type: str
    width: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.type]

    def ddl(self, dialect: str) -> str:
        if self.type == "string" and self.width:
            return f"{self.name} VARCHAR({self.width})"
        name = _JDBC_NAMES[self.type] if dialect == "jdbc" else self.type.upper()
        return f"{self.name} {name}"


@dataclass(frozen=True)
class Table:
    """A served table: ordered columns, primary key and folder under the root.

    Rows are sorted by ``sort`` within each file, without a shuffle. Filters on those
    columns then skip most row groups and pages, and equal values compress.
    """

    name: str
    folder: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    sort: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def widths(self) -> dict[str, int]:
        return {c.name: c.width for c in self.columns if c.width}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    def ddl(self, dialect: str = "spark") -> str:
        """Column list of a CREATE TABLE; the key is declared for databases only."""
        if dialect == "jdbc":
            parts = [c.ddl(dialect) for c in self.columns]
            return ", ".join([*parts, f"PRIMARY KEY ({', '.join(self.key)})"])
        quoted = [replace(c, name="`" + c.name.replace("`", "``") + "`") for c in self.columns]
        return ", ".join(c.ddl(dialect) for c in quoted)


@dataclass(frozen=True)
class Contract:
    """The whole flow: raw headers, required columns, key, ranking and outputs."""

    headers: dict[str, str]
    columns: tuple[Column, ...]
    required: tuple[str, ...]
    key: tuple[str, ...]
    highest: tuple[str, ...]
    cleaned_folder: str
    tables: tuple[Table, ...]
    tie_break: tuple[str, ...] | None = None

    @property
    def cleaned(self) -> Table:
        return Table("cleaned", self.cleaned_folder, self.columns, self.key)


# Raw header -> stored column name.
PLAYER_HEADERS = {
    "Known As": "short_name",
    "Full Name": "full_name",
    "Age": "age",
    "Nationality": "nationality",
    "Overall": "overall",
    "Potential": "potential",
    "Club Name": "club_name",
    "Value(in Euro)": "value_eur",
    "Wage(in Euro)": "wage_eur",
    "Positions Played": "player_positions",
    "Preferred Foot": "preferred_foot",
}

# Stored type and width of each column.
SHORT_NAME = Column("short_name", "string", 100)
FULL_NAME = Column("full_name", "string", 255)
AGE = Column("age", "int")
NATIONALITY = Column("nationality", "string", 100)
OVERALL = Column("overall", "int")
POTENTIAL = Column("potential", "int")
CLUB_NAME = Column("club_name", "string", 100)
VALUE_EUR = Column("value_eur", "double")
WAGE_EUR = Column("wage_eur", "double")
PLAYER_POSITIONS = Column("player_positions", "string", 100)
PREFERRED_FOOT = Column("preferred_foot", "string", 10)

PLAYERS = Contract(
    headers=PLAYER_HEADERS,
    columns=(SHORT_NAME, FULL_NAME, AGE, NATIONALITY, OVERALL, POTENTIAL, CLUB_NAME,
             VALUE_EUR, WAGE_EUR, PLAYER_POSITIONS, PREFERRED_FOOT),
    required=("short_name", "value_eur", "club_name", "full_name"),
    key=("full_name",),
    highest=("overall",),
    cleaned_folder="stage1/cleaned_players",
    tables=(
        Table("master_player_table", "stage2/master_player_table",
              (FULL_NAME, SHORT_NAME, AGE, NATIONALITY, OVERALL, POTENTIAL, CLUB_NAME,
               VALUE_EUR, WAGE_EUR, PREFERRED_FOOT), ("full_name",),
              sort=("nationality", "overall")),
        Table("player_metadata", "stage3/player_metadata",
              (FULL_NAME, SHORT_NAME, PLAYER_POSITIONS, AGE, NATIONALITY, PREFERRED_FOOT),
              ("full_name",)),
        Table("club_metadata", "stage3/club_metadata", (CLUB_NAME,), ("club_name",)),
    ),
)
