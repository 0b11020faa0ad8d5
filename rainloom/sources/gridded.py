"""Gridded files into tidy rows; needs the optional libraries that read them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RENAMES = {"lon": "longitude", "X": "longitude", "lat": "latitude", "Y": "latitude", "M": "number", "T": "time", "S": "start_time", "L": "lead"}


def standardise(df: DataFrame) -> DataFrame:
    """Coordinate columns under their usual names, each only where the usual one is absent; ValueError where two would take one name."""
    new = {a: b for a, b in RENAMES.items() if a in df.columns and b not in df.columns}
    if len(set(new.values())) < len(new):
        raise ValueError(f"several columns stand for one coordinate: {sorted(new)}")
    return df.withColumnsRenamed(new)


class _Reader(DataSourceReader):
    def __init__(self, path: str, engine: str) -> None:
        self.path, self.engine = path, engine

    def partitions(self) -> list[InputPartition]:
        import glob

        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import xarray

        with xarray.open_dataset(partition.value, engine=self.engine) as data:
            for name in data.data_vars:
                for block in data[name].to_dataframe().reset_index().dropna(subset=[name]).itertuples(index=False):
                    row = block._asdict()
                    yield partition.value, str(name), float(row.pop(name)), {k: str(v) for k, v in row.items()}


class GriddedFiles(DataSource):
    """`spark.read.format("gridded").option("engine", "cfgrib").load("*.grib")`: one partition per file."""

    @classmethod
    def name(cls) -> str:
        return "gridded"

    def schema(self) -> str:
        return "file_name string, variable string, value double, coordinates map<string,string>"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(self.options["path"], self.options.get("engine", "netcdf4"))
