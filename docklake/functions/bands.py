"""Range labels of district figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (exclusive upper bound, label) of each band, then the label of the open last band.
DENSITY_BANDS = (
    (10, "[0 - 10)"), (15, "[10 - 15)"), (20, "[15 - 20)"), (25, "[20 - 25)"), (30, "[25 - 30)"),
)
DENSITY_TOP = "[30+"
POPULATION_BANDS = ((100, "[0 - 100)"), (150, "[100 - 150)"), (200, "[150 - 20)"))
POPULATION_TOP = "[200+"
SIZE_BANDS = ((5, "[0 - 5)"), (10, "[5 - 10)"), (15, "[10 - 15)"), (20, "[15 - 20)"))
SIZE_TOP = "[20+"

# The third population label as documented; the compatible one above lacks a zero.
POPULATION_BANDS_DOCUMENTED = POPULATION_BANDS[:2] + ((200, "[150 - 200)"),)


def band_label(value: Column, bands: tuple[tuple[float, str], ...], top: str) -> Column:
    label = F.when(value.isNull(), F.lit(None))
    for upper, name in bands:
        label = label.when(value < upper, name)
    return label.otherwise(top)


def district_bands(
    density: Column, population: Column, size: Column, label_mode: str = "compatible"
) -> dict[str, Column]:
    """``compatible`` compares the raw figures, ``thousands`` first divides density and
    population by 1000, which is what the labels are documented to mean."""
    if label_mode == "compatible":
        people = POPULATION_BANDS
    elif label_mode == "thousands":
        density, population, people = density / 1000, population / 1000, POPULATION_BANDS_DOCUMENTED
    else:
        raise ValueError(f"unknown label mode {label_mode!r}")
    return {
        "pop_density_range": band_label(density, DENSITY_BANDS, DENSITY_TOP),
        "pop_range": band_label(population, people, POPULATION_TOP),
        "size_range": band_label(size, SIZE_BANDS, SIZE_TOP),
    }
