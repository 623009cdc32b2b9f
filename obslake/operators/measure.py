"""Which columns of a table hold the reading, its time and its place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """Column names; the defaults are those of the observation table.

    Among equal readings the first by ``when``, then by ``tiebreak`` wins,
    so every answer comes from one row and does not depend on file order.
    """

    value: str = "screen_temperature"
    when: str = "observation_date"
    place: str = "region"
    country: str | None = "country"
    tiebreak: tuple[str, ...] = ("observation_time", "region", "forecast_site_code")

    @property
    def reading(self) -> Column:
        """The value with NaN as null; NaN would otherwise rank highest."""
        value = F.col(self.value)
        return F.when(~F.isnan(value), value)

    @property
    def payload(self) -> list[str]:
        """The columns of an answer, in the order in which they break ties."""
        names = [self.when, *self.tiebreak, self.place]
        if self.country:
            names.append(self.country)
        return list(dict.fromkeys(names))

    @property
    def order(self) -> list[Column]:
        """Sort order among equal readings."""
        return [F.col(name).asc_nulls_last() for name in self.payload]

    def rank(self) -> Column:
        """One struct per row whose minimum is the hottest row; null without a reading.

        The value is negated and nulls get a flag in front of them, since the
        smallest struct wins and null is the smallest value of a type.
        """
        fields = [(-self.reading).alias("negative")]
        for name in self.payload:
            fields += [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]
        return F.when(self.reading.isNotNull(), F.struct(*fields))
