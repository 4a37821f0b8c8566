"""Table contracts and the fixed values of the station network."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- fixed values: column names, sensor names, dates and ids of the network ---

RAIN_METRICS = ["m05", "m10", "m15", "h01", "h04", "h24", "h96"]
RAIN_METRICS_FULL = [
    "m05", "m10", "m15", "h01", "h02", "h03", "h04", "h06", "h12", "h24", "h96", "mes",
]
WEATHER_METRICS = [
    "chuva", "dirVento", "velVento", "temperatura", "pressao", "umidade", "ponto_orvalho",
]

# Output column -> sensor name as stored in the source (one is misspelled there).
SENSORS = {
    "dirVento": "Direcao do Vento",
    "velVento": "Velocidade do Vento",
    "temperatura": "Temperatuda do Ar",
    "pressao": "Pressao ATM",
    "umidade": "Umidade do Ar",
}

WEATHER_STATIONS = [1, 11, 16, 19, 20, 22, 28, 32]

# Gauges report every 15 minutes before the cut-over and every 5 minutes after.
class Cutover(NamedTuple):
    """When 5-minute reporting starts, and the stations (by name prefix) that start later."""

    start: str
    late_start: str
    late_names: list[str]


CUTOVER = Cutover("2020-02-01 00:00:00", "2020-03-01 00:00:00", ["Guaratiba", "Sao Cristovao", "São Cristóvão"])

# Missing rain value stored as a number.
SENTINEL = -99.99

LOCAL_ZONE = "America/Sao_Paulo"
FIRST_YEAR = 1997
EPOCH_UTC = "1997-01-01 00:00:00"

# --- contracts ---

_TIME_COLUMNS = [
    T.StructField("dia_utc", T.TimestampType(), False),
    T.StructField("dia", T.TimestampNTZType(), True),
    T.StructField("dia_original", T.StringType(), True),
    T.StructField("utc_offset", T.StringType(), True),
]

REPLICA_RAIN = T.StructType(
    [T.StructField("dia", T.TimestampType(), False)]
    + [T.StructField(m, T.DecimalType(10, 2), True) for m in RAIN_METRICS]
    + [
        T.StructField("estacao", T.StringType(), True),
        T.StructField("estacao_id", T.IntegerType(), False),
    ]
)

WAREHOUSE_RAIN = T.StructType(
    _TIME_COLUMNS
    + [T.StructField(m, T.DoubleType(), True) for m in RAIN_METRICS_FULL]
    + [
        T.StructField("estacao", T.StringType(), True),
        T.StructField("estacao_id", T.LongType(), False),
    ]
)

WAREHOUSE_WEATHER = T.StructType(
    _TIME_COLUMNS
    + [
        T.StructField("estacao", T.StringType(), True),
        T.StructField("estacao_id", T.LongType(), False),
    ]
    + [T.StructField(m, T.DoubleType(), True) for m in WEATHER_METRICS]
)
