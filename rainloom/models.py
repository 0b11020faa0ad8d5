"""The contract of forecast models and the non-parametric one."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame

from rainloom.operators import forecast as fc


class ForecastModel(ABC):
    """Learns from a hindcast and turns a forecast into probabilities; both are `acc` tables."""

    @abstractmethod
    def fit(self, hindcast: DataFrame) -> ForecastModel:
        """Keeps what `hindcast` tells about normal amounts."""

    @abstractmethod
    def transform(self, forecast: DataFrame) -> DataFrame:
        """Probabilities per model, cell and period."""


class NonParametric(ForecastModel):
    """Shares of members beyond the quantiles of the hindcast."""

    def __init__(self) -> None:
        self.limits: DataFrame | None = None

    def fit(self, hindcast: DataFrame) -> NonParametric:
        self.limits = fc.thresholds(hindcast)
        return self

    def transform(self, forecast: DataFrame) -> DataFrame:
        if self.limits is None:
            raise ValueError("fit the model first")
        return fc.probabilities(forecast, self.limits)
