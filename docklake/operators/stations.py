"""Building the station dimension from raw stations and supplied geography tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.functions import text
from docklake.operators.keyed import earliest_per_key

# The districts of the city and the neighborhoods each of them holds.
DISTRICT_NEIGHBORHOODS = {
    "Ciutat Vella": [
        "La Barceloneta", "el Gòtic", "el Raval", "Sant Pere, Santa Caterina i la Ribera",
    ],
    "Eixample": [
        "L'Antiga Esquerra de l'Eixample", "la Nova Esquerra de l'Eixample", "Dreta de l'Eixample",
        "Fort Pienc", "Barri de la Sagrada Família", "Sant Antoni (Eixample)",
    ],
    "Sants-Montjuïc": [
        "La Bordeta (Sants-Montjuïc)", "la Font de la Guatlla", "Hostafrancs", "La Marina de Port",
        "La Marina del Prat Vermell", "El Poble-sec (Sants-Montjuïc)", "Sants", "Sants-Badal",
        "Montjuïc (Barcelona)", "Zona Franca - Port",
    ],
    "Les Corts": [
        "Barri de les Corts", "La Maternitat i Sant Ramon", "Pedralbes",
    ],
    "Sarrià - Sant Gervasi": [
        "El Putget i Farró", "Sarrià (Barcelona)", "Sant Gervasi - la Bonanova",
        "Sant Gervasi - Galvany", "Les Tres Torres", "Vallvidrera, el Tibidabo i les Planes",
    ],
    "Gràcia": [
        "Vila de Gràcia", "Camp d'en Grassot i Gràcia Nova", "La Salut", "El Coll",
        "Vallcarca i els Penitents",
    ],
    "Horta-Guinardó": [
        "El Baix Guinardó", "El Guinardó", "Can Baró", "El Carmel", "La Font d'en Fargues",
        "Barri d'Horta", "La Clota", "Montbau", "Sant Genís dels Agudells", "La Teixonera",
        "La Vall d'Hebron",
    ],
    "Nou Barris": [
        "Can Peguera", "Canyelles (Nou Barris)", "Ciutat Meridiana", "La Guineueta",
        "Porta (Nou Barris)", "La Prosperitat", "Les Roquetes (Nou Barris)", "Torre Baró",
        "La Trinitat Nova", "El Turó de la Peira", "Vallbona (Nou Barris)", "Verdum (Nou Barris)",
        "Vilapicina i la Torre Llobeta",
    ],
    "Districte de Sant Andreu": [
        "Baró de Viver", "Bon Pastor (Sant Andreu)", "El Congrés i els Indians", "Navas",
        "Sant Andreu de Palomar", "La Sagrera", "Trinitat Vella",
    ],
    "Districte de Sant Martí": [
        "El Besós i el Maresme", "El Clot", "El Camp de l'Arpa del Clot",
        "Diagonal Mar i el Front Marítim del Poblenou", "El Parc i la Llacuna del Poblenou",
        "Poblenou", "Provençals del Poblenou", "Sant Martí de Provençals", "La Verneda i la Pau",
        "La Vila Olímpica del Poblenou",
    ],
}


def default_districts(spark: SparkSession) -> DataFrame:
    """(district, neighborhoods) of the shipped city."""
    rows = list(DISTRICT_NEIGHBORHOODS.items())
    return spark.createDataFrame(rows, "district string, neighborhoods array<string>")


def neighborhood_districts(districts: DataFrame) -> DataFrame:
    """(neighborhood, district) from (district, neighborhoods)."""
    return districts.select(F.explode("neighborhoods").alias("neighborhood"), "district")


def resolve_geography(stations: DataFrame, candidates: DataFrame, districts: DataFrame) -> DataFrame:
    """Fill missing district and neighborhood of stations (id, district, neighborhood, ...).

    ``candidates`` (id, rank, place) lists nearby place names. Only a station without neighborhood
    takes the first place that is a neighborhood, and with it that neighborhood's district; a
    station still without district takes the first place that is one. Neither tables nor lists are
    assumed small: each lookup is an equi join followed by a combined aggregate per station.
    """
    by_name = neighborhood_districts(districts).withColumnRenamed("neighborhood", "place")
    near = earliest_per_key(candidates.join(by_name, "place"), ["id"], ["rank"]).select(
        "id", F.col("place").alias("_near"), F.col("district").alias("_near_district")
    )
    names = districts.select(F.col("district").alias("place"))
    within = earliest_per_key(candidates.join(names, "place"), ["id"], ["rank"]).select(
        "id", F.col("place").alias("_within")
    )
    found = F.col("neighborhood").isNull() & F.col("_near").isNotNull()
    joined = stations.join(near, "id", "left").join(within, "id", "left")
    resolved = joined.withColumns(
        {
            "district": F.coalesce(F.when(found, F.col("_near_district")), "district", "_within"),
            "neighborhood": F.coalesce("neighborhood", "_near"),
        }
    )
    return resolved.select(*stations.columns)


def district_statistics(pages: DataFrame) -> DataFrame:
    """Complete figures per district from ranked candidates (district, rank, size, population,
    density): the first candidate that has all three."""
    whole = pages.where(
        F.col("size").isNotNull() & F.col("population").isNotNull() & F.col("density").isNotNull()
    )
    return earliest_per_key(whole, ["district"], ["rank"]).drop("rank")


def page_statistics(pages: DataFrame) -> DataFrame:
    """Figures read from the size cell and the population cell of district pages."""
    return pages.select(
        "district",
        "rank",
        text.district_size(F.col("size_text")).alias("size"),
        text.district_population(F.col("population_text")).alias("population"),
        text.district_density(F.col("population_text")).alias("density"),
    )


def geocoded(stations: DataFrame, results: DataFrame) -> DataFrame:
    """Stations (id, ...) with district, neighborhood and postal code from ranked geocoder results
    (id, rank, sublocality, neighborhood, formatted): each is its first non-null value."""
    first = {
        "district": F.col("sublocality"),
        "neighborhood": F.col("neighborhood"),
        "postal_code": text.postal_code(F.col("formatted")),
    }
    picked = results.groupBy("id").agg(
        *(F.min_by(value, F.when(value.isNotNull(), F.col("rank"))).alias(name) for name, value in first.items())
    )
    return stations.join(picked, "id", "left")


def apply_synonyms(stations: DataFrame, synonyms: DataFrame, column: str) -> DataFrame:
    """Replace spellings of ``column`` by (spelling, name); others stay. Of several names of a spelling the first by
    alphabet counts, so no station is repeated."""
    names = synonyms.groupBy(F.col("spelling").alias(column)).agg(F.min("name").alias("_name"))
    merged = stations.join(names, column, "left")
    return merged.withColumn(column, F.coalesce("_name", column)).select(*stations.columns)


def station_dimension(stations: DataFrame, statistics: DataFrame) -> DataFrame:
    """Dimension rows of located stations and district figures. Quotes in texts become double."""
    figures = statistics.select(
        "district", F.col("density").alias("pop_density"), "population", "size"
    )
    c = F.col
    return stations.join(figures, "district", "left").select(
        c("id").cast("bigint").alias("id"),
        "longitude",
        "latitude",
        c("height").cast("bigint").alias("heigh"),
        *(text.double_quotes(c(n)).alias(n) for n in ("district", "neighborhood", "postal_code")),
        text.double_quotes(text.address(c("street"), c("street_number"))).alias("address"),
        "pop_density",
        "population",
        "size",
    )


def built_dimension(
    sites: DataFrame, answers: DataFrame, candidates: DataFrame, districts: DataFrame, pages: DataFrame
) -> DataFrame:
    """The station dimension from its sources, as a refresh of it runs.

    ``sites`` (id, longitude, latitude, height, street, street_number) get district, neighborhood and postal code from
    geocoder ``answers`` (id, rank, sublocality, neighborhood, formatted), what is missing from nearby places
    (``candidates``: id, rank, place) and the ``districts`` (district, neighborhoods) they name, and figures from
    district ``pages`` (district, rank, size_text, population_text). A site keeps its row without any of those.
    """
    located = resolve_geography(geocoded(sites, answers), candidates, districts)
    return station_dimension(located, district_statistics(page_statistics(pages)))
