"""Names of the columns that the operators work on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Window, WindowSpec

#: Pollutants in the order that breaks ties.
POLLUTANTS = ("pm25", "pm10", "no2", "so2", "co", "o3")
WEATHER = ("temperature", "humidity", "pressure", "wind_speed")


@dataclass(frozen=True)
class Columns:
    entity: str = "city"
    time: str = "timestamp"
    target: str = "aqi"
    order: str = "ingest_seq"
    pollutants: tuple[str, ...] = POLLUTANTS
    weather: tuple[str, ...] = WEATHER
    #: Further columns that windows of an entity are split by, see operators.windows.in_blocks.
    parts: tuple[str, ...] = ()

    @property
    def key(self) -> list[str]:
        return [self.entity, self.time]

    @property
    def measures(self) -> list[str]:
        return [self.target, *self.pollutants, *self.weather]

    def window(self) -> WindowSpec:
        return Window.partitionBy(self.entity, *self.parts).orderBy(self.time)


@dataclass(frozen=True)
class FeatureConfig:
    """Which lags, windows, differences and horizons the feature chain builds."""

    #: Hours of lags, windows, differences and horizons.
    target_lags: tuple[int, ...] = (1, 3, 6, 12, 24, 48, 72)
    pollutant_lags: tuple[int, ...] = (1, 3, 6, 24, 72)
    weather_lags: tuple[int, ...] = (1, 3, 6, 24)
    windows: tuple[int, ...] = (6, 12, 24, 48, 168)
    differences: tuple[int, ...] = (1, 3, 6, 24)
    horizons: tuple[int, ...] = (24, 48, 72)
    #: Fixed values: (month, day).
    holidays: tuple[tuple[int, int], ...] = ((3, 23), (8, 14), (12, 25))
    #: Entities that always have a flag of their own.
    cities: tuple[str, ...] = ("Islamabad", "Karachi", "Lahore")
    #: Which rolling features there are: exponential averages, quartiles, ranges.
    emas: bool = True
    quantiles: bool = False
    ranges: bool = True
    #: Rolling features as 32-bit floats, for half the space.
    float32: bool = False
    #: Name, latitude and longitude of a place that distances are told to, if any.
    place: tuple[str, float, float] | None = None
    columns: Columns = field(default_factory=Columns)
