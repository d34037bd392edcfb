"""Constants that are part of the results, and the parameters built from them."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: results depend on them ---------------------------------

# (tienda_id, nombre, tamano, lead_time in days)
TIENDAS = (
    ("T01", "Madrid Centro", 1.35, 2),
    ("T02", "Barcelona Diagonal", 1.15, 3),
    ("T03", "Valencia Norte", 0.85, 4),
    ("T04", "Sevilla Este", 0.75, 5),
    ("T05", "Bilbao Abando", 0.60, 4),
)

# Sales factor by weekday, Monday first.
FACTOR_DIA = (0.88, 0.86, 0.92, 1.00, 1.22, 1.35, 0.62)

# Service level -> z; 95 % is the default.
Z_POR_NIVEL = {"90": 1.28, "95": 1.65, "98": 2.05, "99": 2.33}

HORIZONTES = (1, 3, 7, 14)

HISTORICO = "historico"
STREAMING = "streaming"

SIN_IDENTIFICADOR = "sin identificador"
SKU_NO_CATALOGADO = "sku no catalogado"
UNIDADES_NO_VALIDAS = "unidades no validas"
PRECIO_NO_VALIDO = "precio no valido"
IMPORTE_NO_VALIDO = "importe no valido"

# A price or amount from here on, infinite or not a number is an error of the feed; sums of
# a hundred million smaller ones can still be rounded.
IMPORTE_MAXIMO = 1e12

CRITICO, ALTO, MEDIO, OK = "CRITICO", "ALTO", "MEDIO", "OK"
PUNTOS_NIVEL = {CRITICO: 1000, ALTO: 500, MEDIO: 100, OK: 0}
PUNTOS_PROBABILIDAD = 90

COBERTURA_MAXIMA = 999
VARIABLES = (
    "media_7", "media_28", "desv_14", "quiebres_14",
    "stock", "en_camino", "dias_cobertura", "lead_time",
)

# --- Parameters -----------------------------------------------------------

SERIE = ["tienda_id", "sku"]
SERIE_DIA = ["tienda_id", "sku", "fecha"]


@dataclass(frozen=True)
class Params:
    """Tunable numbers of one run; the defaults are the documented ones."""

    z_servicio: float = Z_POR_NIVEL["95"]
    horizontes: tuple[int, ...] = HORIZONTES
    dias_test: int = 7
    # Forest
    arboles: int = 50
    profundidad: int = 8
    semilla: int = 42
    # Remember each row's node per tree: saves a third of the fit for four bytes per row and tree.
    guardar_nodos: bool = True
    # Train on about this many rows, drawn by a hash of series and day; None is all of them.
    filas_entrenamiento: int | None = None
    # Stricter labelling, off by default
    full_horizon_only: bool = False
    embargo_days: int = 0
