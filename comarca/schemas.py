"""Names and types of the three sources and of the declared star schema.

All lists here are fixed values: they have to equal the published files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INDICATOR_FILE = "despob_pob_actividad_activos_ipc_pib_2023_clusters.csv"
PIPELINE_VERSION = "1.0.0"
# The column in which readers list cells that did not parse.
REJECTED_CELLS = "rejected_cells"

# The columns of the indicator file, in file order.
INDICATOR_COLUMNS = [
    ("cod_prov", "int"),
    ("nom_prov", "string"),
    ("porcen_desp", "bigint"),
    ("pob_tot", "bigint"),
    ("pob_hom", "bigint"),
    ("pob_muj", "bigint"),
    ("asexos_tactividad", "double"),
    ("asexos_templeo", "double"),
    ("asexos_tparo", "double"),
    ("hombres_tactividad", "double"),
    ("hombres_templeo", "double"),
    ("hombres_tparo", "double"),
    ("mujeres_tactividad", "double"),
    ("mujeres_templeo", "double"),
    ("mujeres_tparo", "double"),
    ("ocupados_agricultura", "double"),
    ("ocupados_construccion", "double"),
    ("ocupados_industria", "double"),
    ("ocupados_servicios", "double"),
    ("ipc_alim", "double"),
    ("ipc_bebi", "double"),
    ("ipc_vest", "double"),
    ("ipc_vivi", "double"),
    ("ipc_hoga", "double"),
    ("ipc_sani", "double"),
    ("ipc_trans", "double"),
    ("ipc_comu", "double"),
    ("ipc_ocio", "double"),
    ("ipc_ense", "double"),
    ("ipc_resta", "double"),
    ("ipc_otros", "double"),
    ("pib_prec", "bigint"),
    ("pib_agri", "bigint"),
    ("pib_indu", "bigint"),
    ("pib_ind_manu", "bigint"),
    ("pib_constr", "bigint"),
    ("pib_comer", "bigint"),
    ("pib_act_fin", "bigint"),
    ("pib_admin", "bigint"),
    ("pib_valor_brut", "bigint"),
    ("pib_imp_netos", "bigint"),
    ("group", "int"),
    ("kmeans_group", "int"),
    ("dbscan_group", "int"),
    ("em_group", "int"),
]
INDICATOR_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in INDICATOR_COLUMNS)

INDICATOR_RENAMES = {
    "cod_prov": "codigo_provincia",
    "nom_prov": "nombre_provincia",
    "porcen_desp": "porcentaje_despoblamiento",
    "pob_tot": "poblacion_total",
    "pob_hom": "poblacion_hombres",
    "pob_muj": "poblacion_mujeres",
    "asexos_tactividad": "tasa_actividad_total",
    "asexos_templeo": "tasa_empleo_total",
    "asexos_tparo": "tasa_paro_total",
    "ipc_alim": "ipc_alimentacion",
    "ipc_trans": "ipc_transporte",
    "pib_prec": "pib_precios_corrientes",
}

POPULATION_SCHEMA = (
    "codigo_provincia int, nombre_provincia string, Municipios string, Sexo string, Periodo string, Total string"
)

# Province names as they appear in the industry file names, with their INE codes.
PROVINCE_CODES = {
    "Alava": 1,
    "Albacete": 2,
    "Alicante": 3,
    "Almeria": 4,
    "Avila": 5,
    "Badajoz": 6,
    "Barcelona": 8,
    "Bizkaia": 48,
    "Burgos": 9,
    "Caceres": 10,
    "Cadiz": 11,
    "Cantabria": 39,
    "Castellon": 12,
    "Cordoba": 14,
    "Coruña": 15,
    "CReal": 13,
    "Cuenca": 16,
    "Gipuzkoa": 20,
    "Girona": 17,
    "Granada": 18,
    "Guadalajara": 19,
    "Huelva": 21,
    "Huesca": 22,
    "Jaen": 23,
    "Lleida": 25,
    "Lugo": 27,
    "Madrid": 28,
    "Malaga": 29,
    "Murcia": 30,
    "Navarra": 31,
    "Ourense": 32,
    "Palencia": 34,
    "Pontevedra": 36,
    "Rioja": 26,
    "Salamanca": 37,
    "Segovia": 40,
    "Sevilla": 41,
    "Tarragona": 43,
    "Teruel": 44,
    "Toledo": 45,
    "Valencia": 46,
    "Valladolid": 47,
    "Zamora": 49,
    "Zaragoza": 50,
}

SECTOR_COLUMN = "aaee_seccion_cnae09"


@dataclass(frozen=True)
class SexLabels:
    """Values of the ``sexo`` column; ``total`` marks rows already summed over the others."""

    total: str = "Total"
    men: str = "Hombres"
    women: str = "Mujeres"


_CREATED = T.StructField("created_at", T.TimestampType())


def _declared(*fields: tuple[str, T.DataType]) -> T.StructType:
    key, *rest = fields
    return T.StructType([T.StructField(*key, nullable=False), *(T.StructField(*f) for f in rest), _CREATED])


# Declared star schema; the first column of each table is its primary key.
STAR_SCHEMA = {
    "dim_provincia": _declared(
        ("codigo_provincia", T.IntegerType()),
        ("nombre_provincia", T.VarcharType(100)),
    ),
    "dim_municipio": _declared(
        ("id_municipio", T.IntegerType()),
        ("codigo_municipio", T.VarcharType(20)),
        ("nombre_municipio", T.VarcharType(200)),
        ("codigo_provincia", T.IntegerType()),
    ),
    "fact_despoblamiento": _declared(
        ("id", T.IntegerType()),
        ("codigo_provincia", T.IntegerType()),
        ("porcen_desp", T.FloatType()),
        ("pob_tot", T.IntegerType()),
        ("pob_hom", T.IntegerType()),
        ("pob_muj", T.IntegerType()),
        ("tasa_actividad", T.FloatType()),
        ("tasa_empleo", T.FloatType()),
        ("tasa_paro", T.FloatType()),
        ("ipc_general", T.FloatType()),
        ("pib_total", T.FloatType()),
        ("anio", T.IntegerType()),
    ),
    "fact_poblacion_municipio": _declared(
        ("id", T.IntegerType()),
        ("codigo_provincia", T.IntegerType()),
        ("codigo_municipio", T.VarcharType(20)),
        ("sexo", T.VarcharType(20)),
        ("periodo", T.IntegerType()),
        ("total_poblacion", T.IntegerType()),
    ),
    "fact_industria": _declared(
        ("id", T.IntegerType()),
        ("codigo_provincia", T.IntegerType()),
        ("nombre_provincia", T.VarcharType(100)),
        ("sector", T.VarcharType(200)),
        ("valor", T.FloatType()),
        ("anio", T.IntegerType()),
    ),
}
