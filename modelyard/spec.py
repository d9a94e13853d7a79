"""The tabular data contract: column order, types and request layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Ordered model inputs plus the target; order is part of the contract."""

    numeric: tuple[str, ...]
    nominal: tuple[str, ...] = ()
    ordinal: tuple[str, ...] = ()
    target: str = "cost"

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.nominal + self.ordinal

    @property
    def columns(self) -> tuple[str, ...]:
        return self.features + (self.target,)

    def require(self, df: DataFrame, columns: tuple[str, ...] | None = None) -> None:
        missing = [c for c in (columns or self.columns) if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing from the input: {missing}")

    def project(self, df: DataFrame, *keep: str) -> DataFrame:
        """Contract columns in contract order, after any extra key columns."""
        self.require(df)
        return df.select(*keep, *self.columns)


# Names and order of the trip contract.
TRIPS = FeatureSpec(
    numeric=(
        "distance",
        "dropoff_latitude", "dropoff_longitude",
        "passengers",
        "pickup_latitude", "pickup_longitude",
        "pickup_weekday", "pickup_month", "pickup_monthday",
        "pickup_hour", "pickup_minute", "pickup_second",
        "dropoff_weekday", "dropoff_month", "dropoff_monthday",
        "dropoff_hour", "dropoff_minute", "dropoff_second",
    ),
    nominal=("store_forward", "vendor"),
    target="cost",
)

_DOUBLES = {"cost", "distance"} | {
    f"{end}_{axis}" for end in ("pickup", "dropoff") for axis in ("latitude", "longitude")
}

TRIP_SCHEMA = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in _DOUBLES else T.IntegerType())
        for name in TRIPS.columns
    ]
)

FEATURE_SCHEMA = T.StructType([f for f in TRIP_SCHEMA if f.name != TRIPS.target])

# Positional requests carry the two nominal columns before the calendar parts.
POSITIONAL_LAYOUT = TRIPS.numeric[:6] + TRIPS.nominal + TRIPS.numeric[6:]


def typed(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Select the schema's columns by name and cast each one."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
