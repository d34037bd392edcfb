"""SQL twins: the rules of ``harness.derive`` and the operators, written for another engine."""

from __future__ import annotations

import re

from anaquel.settings import FACTOR_DIA, TIENDAS, VARIABLES
from harness.derive import AS_OF


def rnd(expression: str, digits: int) -> str:
    return f"CAST(round(CAST(({expression}) AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


_STORES = ", ".join(f"('{i}', '{n}', {lead})" for i, n, _, lead in TIENDAS)
_WEEKDAYS = ", ".join(f"({(k + 1) % 7 + 1}, {f})" for k, f in enumerate(FACTOR_DIA))

# Named steps; each query takes along the ones it mentions, directly or through another.
CTES = {
    "lineas": f"""
        SELECT CASE WHEN l_orderkey % 500 = 13 THEN NULL
                    ELSE concat(l_orderkey, '-', l_linenumber) END AS venta_id,
               CAST(l_shipdate AS TIMESTAMP) AS momento,
               concat('T0', n_regionkey + 1) AS tienda_id,
               CASE WHEN l_orderkey % 200 = 11 THEN concat('SIN-CATALOGAR-', l_orderkey % 999)
                    ELSE p_brand END AS sku,
               CAST(CASE l_orderkey % 100 WHEN 7 THEN 0 WHEN 8 THEN -1 ELSE l_quantity END AS INTEGER)
                   AS unidades,
               CASE WHEN l_orderkey % 97 = 3 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS precio,
               {rnd('p_retailprice * l_quantity', 2)} AS importe,
               CAST(l_orderkey % 3 AS INTEGER) AS particion,
               l_orderkey * 10 + l_linenumber AS offset_kafka,
               CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey % 120) AS recibido,
               l_linestatus AS estado
        FROM lineitem, part, supplier, nation
        WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey AND s_nationkey = n_nationkey""",
    "historia": """
        SELECT venta_id, momento, tienda_id, sku, unidades, precio, importe
        FROM lineas WHERE estado = 'F'""",
    "flujo": """
        SELECT venta_id, momento, tienda_id, sku, unidades, precio, importe,
               particion, offset_kafka, recibido
        FROM lineas WHERE estado = 'O'""",
    "catalogo": f"""
        SELECT CAST(substr(p_brand, 7) AS INTEGER) AS id, p_brand AS title, p_brand AS sku,
               concat('C', CAST(substr(p_brand, 7) AS INTEGER) % 6) AS category,
               CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) % 3 <> 0 THEN p_brand END AS brand,
               {rnd('avg(p_retailprice)', 2)} AS price,
               CAST(count(*) AS INTEGER) AS stock,
               CAST(CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) % 5 <> 0
                    THEN CAST(substr(p_brand, 7) AS INTEGER) % 4 + 1 END AS INTEGER)
                   AS minimumOrderQuantity
        FROM part GROUP BY p_brand""",
    "locales": f"SELECT * FROM (VALUES {_STORES}) AS s(tienda_id, tienda, lead_time)",
    "semana": f"SELECT dia, CAST(factor AS DOUBLE) AS factor "
              f"FROM (VALUES {_WEEKDAYS}) AS w(dia, factor)",
    "indice": f"""
        SELECT CAST(month(m) AS INTEGER) AS FK_Periodo,
               CASE WHEN m < (SELECT max(date_trunc('month', o_orderdate)) FROM orders)
                    THEN total END AS Valor
        FROM (SELECT date_trunc('month', o_orderdate) AS m, {rnd('sum(o_totalprice)', 2)} AS total
              FROM orders GROUP BY 1)""",
    "mensual": """
        SELECT FK_Periodo AS mes, avg(Valor) AS media FROM indice
        WHERE Valor IS NOT NULL AND FK_Periodo BETWEEN 1 AND 12 GROUP BY 1""",
    "factor_mensual": f"""
        SELECT mes, {rnd('coalesce(media, g.v) / g.v', 4)} AS factor
        FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS mes) LEFT JOIN mensual USING (mes),
             (SELECT avg(media) AS v FROM mensual) g""",
    "crudas": """
        SELECT venta_id, momento, tienda_id, sku, unidades, precio, importe,
               CAST(NULL AS TIMESTAMP) AS recibido, CAST(NULL AS INTEGER) AS particion,
               CAST(NULL AS BIGINT) AS offset_kafka, 'historico' AS origen FROM historia
        UNION ALL
        SELECT venta_id, momento, tienda_id, sku, unidades, precio, importe,
               recibido, particion, offset_kafka, 'streaming' FROM flujo""",
    "revisadas": """
        SELECT r.*,
               CASE WHEN venta_id IS NULL THEN 'sin identificador'
                    WHEN sku NOT IN (SELECT sku FROM catalogo) THEN 'sku no catalogado'
                    WHEN coalesce(unidades, 0) <= 0 THEN 'unidades no validas'
                    WHEN coalesce(precio, 0) <= 0 OR abs(precio) >= 1e12 THEN 'precio no valido'
                    WHEN abs(importe) >= 1e12 THEN 'importe no valido' END AS motivo_rechazo
        FROM crudas r""",
    "limpias": """
        SELECT venta_id, momento, CAST(momento AS DATE) AS fecha, tienda_id, sku, unidades, precio,
               importe, recibido, particion, offset_kafka, origen
        FROM revisadas WHERE motivo_rechazo IS NULL
        QUALIFY row_number() OVER (PARTITION BY venta_id ORDER BY origen, momento,
            recibido NULLS FIRST, particion NULLS FIRST, offset_kafka NULLS FIRST,
            tienda_id, sku, unidades, precio, importe) = 1""",
    "rechazadas": """
        SELECT motivo_rechazo, count(*) AS registros FROM revisadas
        WHERE motivo_rechazo IS NOT NULL GROUP BY 1""",
    "calidad": f"""
        SELECT entradas, validas, rechazadas, entradas - validas - rechazadas AS duplicadas,
               coalesce({rnd('validas / nullif(entradas, 0) * 100', 2)}, 0) AS calidad_pct
        FROM (SELECT (SELECT count(*) FROM crudas) AS entradas,
                     (SELECT count(*) FROM limpias) AS validas,
                     (SELECT count(*) FROM revisadas WHERE motivo_rechazo IS NOT NULL) AS rechazadas)""",
    "producto": """
        SELECT sku, title AS nombre, category AS categoria, brand AS marca, price AS precio,
               coalesce(minimumOrderQuantity, 1) AS lote_minimo FROM catalogo""",
    "dias": """
        SELECT CAST(unnest(generate_series(min(fecha)::TIMESTAMP, max(fecha)::TIMESTAMP,
                                           INTERVAL 1 DAY)) AS DATE) AS fecha FROM limpias""",
    "tiempo": """
        SELECT fecha, CAST(month(fecha) AS INTEGER) AS mes, strftime(fecha, '%A') AS nombre_dia,
               m.factor AS indice_ine, w.factor AS factor_dia
        FROM dias, factor_mensual m, semana w
        WHERE m.mes = month(fecha) AND w.dia = dayofweek(fecha) + 1""",
    "ultimo": "SELECT max(fecha) AS d FROM dias",
    "diarias": f"""
        SELECT fecha, tienda_id, sku, CAST(sum(unidades) AS BIGINT) AS unidades,
               {rnd('sum(importe)', 2)} AS importe
        FROM limpias GROUP BY ALL""",
    "malla": "SELECT fecha, tienda_id, lead_time, sku, price FROM dias, locales, catalogo",
    "demanda": """
        SELECT g.*, coalesce(v.unidades, 0) AS u FROM malla g
        LEFT JOIN diarias v USING (fecha, tienda_id, sku)""",
    "llegadas": """
        SELECT fecha, tienda_id, sku, price, u,
               CASE lead_time WHEN 2 THEN sum(u) OVER (s ROWS 1 PRECEDING)
                              WHEN 3 THEN sum(u) OVER (s ROWS 2 PRECEDING)
                              WHEN 4 THEN sum(u) OVER (s ROWS 3 PRECEDING)
                              WHEN 5 THEN sum(u) OVER (s ROWS 4 PRECEDING) END AS camino
        FROM demanda WINDOW s AS (PARTITION BY tienda_id, sku ORDER BY fecha)""",
    "objetivos": f"""
        SELECT tienda_id, sku,
               CAST(ceil({rnd('avg(u) * max(lead_time) + coalesce(stddev_samp(u), 0) * sqrt(max(lead_time))', 6)})
                    AS BIGINT) AS objetivo
        FROM demanda GROUP BY ALL""",
    "existencias": f"""
        SELECT fecha, tienda_id, sku,
               CAST(greatest(objetivo - camino, 0) AS INTEGER) AS stock,
               CAST(camino AS INTEGER) AS en_camino, objetivo <= camino AS quiebre,
               CAST(u AS INTEGER) AS demanda,
               CAST(u - least(u, greatest(camino - objetivo, 0)) AS INTEGER) AS vendidas,
               CAST(least(u, greatest(camino - objetivo, 0)) AS INTEGER) AS no_atendidas,
               {rnd('least(u, greatest(camino - objetivo, 0)) * price', 2)} AS valor_no_atendido
        FROM llegadas JOIN objetivos USING (tienda_id, sku)""",
    "existencias_hoy": """
        SELECT * REPLACE (stock + 1 AS stock, false AS quiebre) FROM existencias
        WHERE fecha = (SELECT d FROM ultimo)""",
    "inventario": """
        SELECT fecha, tienda_id, sku, coalesce(h.stock, e.stock) AS stock,
               coalesce(h.en_camino, e.en_camino) AS en_camino, coalesce(h.quiebre, e.quiebre) AS quiebre
        FROM existencias e FULL JOIN existencias_hoy h USING (fecha, tienda_id, sku)""",
    "hecho": """
        SELECT g.fecha, g.tienda_id, g.sku, coalesce(v.unidades, 0) AS unidades,
               coalesce(v.importe, 0) AS importe, coalesce(i.stock, 0) AS stock,
               coalesce(i.en_camino, 0) AS en_camino, coalesce(i.quiebre, false) AS quiebre
        FROM malla g LEFT JOIN diarias v USING (fecha, tienda_id, sku)
        LEFT JOIN inventario i USING (fecha, tienda_id, sku)""",
    "serie": """
        SELECT h.fecha, tienda_id, sku, unidades, factor_dia, indice_ine,
               unidades / nullif(factor_dia * indice_ine, 0) AS sin_estacion
        FROM hecho h JOIN tiempo USING (fecha)""",
    "diario": f"""
        SELECT fecha, tienda_id, sku, unidades,
               {rnd('coalesce(avg(unidades) OVER semana, 0)', 3)} AS pred_base,
               {rnd('coalesce(avg(sin_estacion) OVER semana, 0) * factor_dia * indice_ine', 3)}
                   AS pred_modelo
        FROM serie WINDOW semana AS (PARTITION BY tienda_id, sku ORDER BY fecha
                                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "errores": f"""
        SELECT count(*) AS observaciones,
               {rnd('avg(abs(pred_base - unidades))', 4)} AS mae_base,
               {rnd('avg(abs(pred_modelo - unidades))', 4)} AS mae_modelo,
               {rnd('sum(abs(pred_modelo - unidades)) / nullif(sum(unidades), 0)', 4)} AS wape_modelo
        FROM diario WHERE fecha > (SELECT d FROM ultimo) - 7""",
    "futuro": """
        SELECT horizonte, fecha, w.factor AS factor_dia, m.factor AS indice_ine
        FROM (SELECT h AS horizonte, d + h AS fecha
              FROM ultimo, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS h)),
             semana w, factor_mensual m
        WHERE w.dia = dayofweek(fecha) + 1 AND m.mes = month(fecha)""",
    "nivel_serie": """
        SELECT tienda_id, sku, pred_modelo / nullif(factor_dia * indice_ine, 0) AS nivel
        FROM diario JOIN tiempo USING (fecha) WHERE fecha = (SELECT d FROM ultimo)""",
    "horizonte_bruto": """
        SELECT tienda_id, sku, horizonte, fecha, greatest(nivel * factor_dia * indice_ine, 0) AS x
        FROM nivel_serie, futuro""",
    "prevista": f"""
        SELECT tienda_id, sku, horizonte, fecha, {rnd('x', 3)} AS demanda,
               {rnd('sum(x) OVER (PARTITION BY tienda_id, sku ORDER BY horizonte ROWS UNBOUNDED PRECEDING)', 3)}
                   AS demanda_acumulada
        FROM horizonte_bruto""",
    "ventanas": """
        SELECT fecha, tienda_id, sku, CAST(stock AS DOUBLE) AS stock,
               CAST(en_camino AS DOUBLE) AS en_camino,
               coalesce(avg(unidades) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS media_7,
               coalesce(avg(unidades) OVER (s ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS media_28,
               coalesce(stddev_samp(unidades) OVER (s ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0)
                   AS desv_14,
               coalesce(sum(quiebre::INT) OVER (s ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0)
                   AS quiebres_14,
               max(quiebre::INT) OVER (s ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS etiqueta
        FROM hecho WINDOW s AS (PARTITION BY tienda_id, sku ORDER BY fecha)""",
    "variables": """
        SELECT v.fecha, tienda_id, sku, categoria, CAST(lead_time AS DOUBLE) AS lead_time, stock,
               en_camino, media_7, media_28, desv_14, CAST(quiebres_14 AS BIGINT) AS quiebres_14,
               CAST(etiqueta AS INTEGER) AS etiqueta,
               CASE WHEN media_7 > 0 THEN least(stock / media_7, 999) ELSE 999 END AS dias_cobertura
        FROM ventanas v JOIN producto USING (sku) JOIN locales USING (tienda_id)""",
    "corte": "SELECT max(fecha) - 7 AS c FROM variables WHERE etiqueta IS NOT NULL",
    "entrena": "SELECT * FROM variables WHERE etiqueta IS NOT NULL AND fecha <= (SELECT c FROM corte)",
    "prueba": "SELECT * FROM variables WHERE etiqueta IS NOT NULL AND fecha > (SELECT c FROM corte)",
    "medias": f"""SELECT {", ".join(rnd(f"avg({v})", 6) + f" AS {v}" for v in VARIABLES)} FROM entrena""",
    "tocones": " UNION ALL ".join(
        f"""SELECT {i}::INT AS arbol, any_value(m.{v}) AS umbral,
            {rnd(f"coalesce(avg(etiqueta) FILTER (e.{v} <= m.{v}), avg(etiqueta))", 6)} AS p1,
            {rnd(f"coalesce(avg(etiqueta) FILTER (NOT e.{v} <= m.{v}), avg(etiqueta))", 6)} AS p2
            FROM entrena e, medias m""" for i, v in enumerate(VARIABLES)
    ),
    "puntuadas": f"""
        SELECT fecha, tienda_id, sku, etiqueta, {rnd("(" + " + ".join(
            f"(SELECT CASE WHEN v.{v} <= umbral THEN p1 ELSE p2 END FROM tocones WHERE arbol = {i})"
            for i, v in enumerate(VARIABLES)) + f") / {len(VARIABLES)}", 6)} AS probabilidad
        FROM variables v""",
    "regla": """
        SELECT count(*) FILTER (etiqueta = 1 AND dias_cobertura <= lead_time) AS vp_regla,
               count(*) FILTER (etiqueta = 0 AND dias_cobertura <= lead_time) AS fp_regla,
               count(*) FILTER (etiqueta = 1 AND dias_cobertura > lead_time) AS fn_regla
        FROM variables WHERE etiqueta IS NOT NULL AND fecha > (SELECT c FROM corte)""",
    "situacion": f"""
        SELECT tienda_id, sku, tienda, lead_time, nombre AS producto, categoria,
               CAST(stock AS DOUBLE) AS stock, CAST(en_camino AS DOUBLE) AS en_camino,
               coalesce(desviacion, 0) AS desviacion,
               {rnd('1.65::DOUBLE * coalesce(desviacion, 0) * sqrt(lead_time)', 2)} AS stock_seguridad
        FROM (SELECT * FROM hecho WHERE fecha = (SELECT d FROM ultimo))
        JOIN (SELECT tienda_id, sku, stddev_samp(unidades) AS desviacion FROM hecho GROUP BY ALL)
             USING (tienda_id, sku)
        JOIN locales USING (tienda_id) JOIN producto USING (sku)""",
    "avisos": f"""
        SELECT tienda_id, tienda, sku, producto, categoria, horizonte, stock, en_camino, lead_time,
               dem AS demanda_prevista, ss AS stock_seguridad, {rnd('dem + ss', 2)} AS punto_pedido,
               {rnd('p', 2)} AS proyectado, CAST(0 AS DOUBLE) AS probabilidad,
               CASE WHEN p <= 0 THEN 'CRITICO' WHEN p < ss THEN 'ALTO'
                    WHEN p < dem + ss THEN 'MEDIO' ELSE 'OK' END AS nivel
        FROM (SELECT s.*, horizonte, demanda_acumulada AS dem, stock_seguridad AS ss,
                     stock + en_camino - demanda_acumulada AS p
              FROM situacion s JOIN prevista USING (tienda_id, sku)
              WHERE horizonte IN (1, 3, 7, 14))""",
    "riesgo": f"""
        SELECT q.* EXCLUDE (precio), {rnd('cantidad_sugerida * precio', 2)} AS valor_en_riesgo,
               CAST(CASE nivel WHEN 'CRITICO' THEN 1000 WHEN 'ALTO' THEN 500
                               WHEN 'MEDIO' THEN 100 ELSE 0 END + probabilidad * 90 AS DOUBLE)
                   AS prioridad
        FROM (SELECT a.*, precio,
                     CASE WHEN nivel = 'OK' THEN 0
                          ELSE greatest(CAST(ceil(punto_pedido - stock - en_camino) AS BIGINT),
                                        lote_minimo) END AS cantidad_sugerida
              FROM avisos a JOIN producto USING (sku)) q""",
    "kpi_riesgo": f"""
        SELECT count(*) FILTER (nivel = 'CRITICO') AS criticas,
               count(*) FILTER (nivel = 'ALTO') AS altas,
               count(*) FILTER (nivel = 'MEDIO') AS medias,
               {rnd("sum(valor_en_riesgo) FILTER (nivel <> 'OK')", 2)} AS valor_en_riesgo
        FROM riesgo WHERE horizonte = 7""",
    "kpi_quiebre": f"""
        SELECT {rnd('avg(CASE WHEN quiebre THEN 100 ELSE 0 END)', 2)} AS tasa_quiebre_pct
        FROM hecho WHERE fecha > (SELECT d FROM ultimo) - 7""",
    "kpi_flujo": f"""
        SELECT n AS ventas_streaming, coalesce({rnd('espera', 2)}, 0) AS latencia_ingesta_seg,
               coalesce(edad, 0) AS antiguedad_dato_seg,
               {rnd('coalesce(edad, 0) / 60', 1)} AS antiguedad_dato_min
        FROM (SELECT count(*) AS n, avg(epoch(recibido) - epoch(momento)) AS espera,
                     CAST(floor(epoch(TIMESTAMP '{AS_OF}')) AS BIGINT)
                     - CAST(floor(epoch(max(momento))) AS BIGINT) AS edad
              FROM limpias WHERE origen = 'streaming')""",
    "eventos": """
        SELECT CAST(event_id AS VARCHAR) AS venta_id, CAST(ts AS TIMESTAMP) AS momento,
               concat('T0', 1 + user_id % 5) AS tienda_id, event_type AS sku,
               CAST(1 AS INTEGER) AS unidades, value AS precio, value AS importe,
               CAST(user_id % 3 AS INTEGER) AS particion, event_id AS offset_kafka
        FROM events""",
    "entregas": """
        SELECT *, momento + to_seconds(CAST(offset_kafka % 120 AS INTEGER)) AS recibido FROM eventos""",
    "latencia": """
        SELECT date_trunc('minute', recibido) AS minuto, count(*) AS ventas, count(momento) AS medidas,
               CAST(sum(epoch_us(recibido) - epoch_us(momento)) AS BIGINT) AS espera_us,
               max(epoch_us(recibido) - epoch_us(momento)) AS espera_max_us, max(momento) AS ultima_venta
        FROM entregas WHERE sku <> 'error' GROUP BY 1""",
}

_SALE_COLS = "venta_id, momento, tienda_id, sku, unidades, precio, importe"
_ALERT_COLS = (
    "tienda, producto, sku, nivel, stock, en_camino, demanda_prevista, proyectado, "
    "cantidad_sugerida, valor_en_riesgo"
)
_SEARCH_COLS = _ALERT_COLS + ", stock_seguridad, probabilidad"
_FOUND = "riesgo WHERE horizonte = 7 AND nivel <> 'OK' ORDER BY prioridad DESC, tienda_id, sku"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_LOADS = " UNION ALL ".join(
    f"SELECT '{t}' AS origen, '{t}.parquet' AS fichero, count(*) AS registros, "
    f"strftime(DATE '2001-11-01' + {n}, '%Y-%m-%dT00:00:00.000000Z') AS fecha FROM {t}"
    for n, t in enumerate(TABLES)
)

def _auc(rows: str, score: str) -> str:
    """Mean rank of the positives among all rows; equal scores share theirs."""
    return f"""
        SELECT {rnd("(sum(r) FILTER (y = 1) - p * (p + 1) / 2) / (p * n)", 6)} AS auc,
               p AS positivos, n AS negativos
        FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r,
                     count(*) FILTER (y = 1) OVER () AS p, count(*) FILTER (y = 0) OVER () AS n
              FROM (SELECT {score} AS s, etiqueta AS y FROM {rows})) GROUP BY p, n"""


_BROKEN = "TRY_CAST(split_part(venta_id, '-', 1) AS BIGINT)"

QUERIES = {
    "rescued_sales": f"""
        SELECT * FROM historia WHERE venta_id IS NULL OR ({_BROKEN} % 50 <> 1 AND {_BROKEN} % 70 <> 2)""",
    "rescued_lines": f"""
        SELECT CASE WHEN {_BROKEN} % 50 = 1 OR {_BROKEN} % 70 = 2 THEN 'linea ilegible' ELSE 'leida' END AS motivo,
               count(*) AS lineas, (SELECT count(*) FROM historia) AS de
        FROM historia GROUP BY 1""",
    "scan_catalog": "SELECT * FROM catalogo",
    "scan_index_series": "SELECT * FROM indice",
    "scan_month_factor": "SELECT * FROM factor_mensual",
    "scan_sales_csv": "SELECT * FROM historia",
    "scan_stream_landed": "SELECT * FROM flujo",
    "scan_inventory_csv": "SELECT * FROM existencias",
    "inventory_merged": "SELECT * FROM inventario",
    "weekday_factor": """
        SELECT dia, factor, CAST(sum(unidades) AS BIGINT) AS unidades
        FROM limpias JOIN semana ON dia = dayofweek(fecha) + 1 GROUP BY ALL""",
    "sink_roundtrip": "SELECT * FROM diarias",
    "sink_json_roundtrip": "SELECT * FROM catalogo",
    "sink_csv_roundtrip": f"SELECT {_ALERT_COLS} FROM riesgo WHERE horizonte = 7 AND nivel <> 'OK'",
    "risk_partitioned": "SELECT * FROM riesgo",
    "lineage_latest": f"SELECT fecha, origen, fichero, registros FROM ({_LOADS}) "
                      f"ORDER BY fecha DESC LIMIT 30",
    "sales_unified": "SELECT * FROM crudas",
    "sales_validated": "SELECT * FROM revisadas",
    "rejects_by_reason": "SELECT * FROM rechazadas",
    "rejects_ranked": "SELECT * FROM rechazadas ORDER BY registros DESC, motivo_rechazo",
    "sales_clean": "SELECT * FROM limpias",
    "quality_report": "SELECT * FROM calidad",
    "feed_freshness": f"""
        SELECT CAST(max(momento) AS DATE) AS ultima,
               CAST(DATE '{AS_OF[:10]}' - CAST(max(momento) AS DATE) AS INTEGER) AS dias,
               DATE '{AS_OF[:10]}' - CAST(max(momento) AS DATE) > 1 AS aviso FROM historia""",
    "dim_product": "SELECT * FROM producto",
    "dim_store": """
        SELECT tienda_id, tienda, lead_time, count(venta_id) AS ventas
        FROM locales LEFT JOIN limpias USING (tienda_id) GROUP BY ALL""",
    "dim_date": "SELECT * FROM tiempo",
    "sales_daily": "SELECT * FROM diarias",
    "fact_sales_dense": "SELECT * FROM hecho",
    "fact_runs": """
        SELECT tienda_id, sku, min(fecha) AS desde, max(fecha) AS hasta, unidades, importe, stock, en_camino, quiebre
        FROM (SELECT *, sum(nuevo) OVER (PARTITION BY tienda_id, sku ORDER BY fecha) AS g
              FROM (SELECT *, CASE WHEN (unidades, importe, stock, en_camino, quiebre)
                                        IS NOT DISTINCT FROM lag((unidades, importe, stock, en_camino, quiebre))
                                        OVER (PARTITION BY tienda_id, sku ORDER BY fecha) THEN 0 ELSE 1 END AS nuevo
                    FROM hecho))
        GROUP BY tienda_id, sku, g, unidades, importe, stock, en_camino, quiebre""",
    "fact_from_runs": "SELECT * FROM hecho",
    "dispersion_from_runs": f"""
        SELECT tienda_id, sku, {rnd('stddev_samp(unidades)', 6)} AS desviacion FROM hecho GROUP BY ALL""",
    "dispersion_from_moments": f"""
        SELECT tienda_id, sku, {rnd('stddev_samp(unidades)', 6)} AS desviacion FROM hecho GROUP BY ALL""",
    "trailing_from_runs": f"""
        SELECT tienda_id, sku, {rnd('media_7', 6)} AS media_7, {rnd('media_28', 6)} AS media_28
        FROM ventanas WHERE fecha = (SELECT d FROM ultimo)""",
    "refreshed_sales": "SELECT * FROM diarias",
    "refreshed_forecast": "SELECT * FROM diario",
    "fact_reconciliation": """
        SELECT CASE WHEN fecha IS NULL THEN 'sin fecha'
                    WHEN tienda_id NOT IN (SELECT tienda_id FROM locales) THEN 'tienda desconocida'
                    ELSE 'en hecho' END AS causa,
               count(*) AS ventas, CAST(sum(unidades) AS BIGINT) AS unidades,
               CASE WHEN causa = 'en hecho' THEN (SELECT CAST(sum(unidades) AS BIGINT) FROM hecho) END
                   AS unidades_hecho
        FROM limpias GROUP BY 1""",
    "fact_grid_check": """
        SELECT f AS filas, e AS esperadas, f = e AS cuadra
        FROM (SELECT (SELECT count(*) FROM hecho) AS f,
                     (SELECT count(*) FROM tiempo) * (SELECT count(*) FROM locales)
                     * (SELECT count(*) FROM producto) AS e)""",
    "seasonal_index": "SELECT * FROM factor_mensual",
    "series_deseasonalised":
        f"SELECT * REPLACE ({rnd('sin_estacion', 6)} AS sin_estacion) FROM serie",
    "forecast_daily": "SELECT * FROM diario",
    "forecast_backtest": "SELECT * FROM errores",
    "forecast_uplift": f"""
        SELECT mae_base, mae_modelo,
               {rnd('(mae_base - mae_modelo) / nullif(mae_base, 0) * 100', 4)} AS mejora_pct
        FROM errores""",
    "future_calendar": "SELECT * FROM futuro",
    "current_level": f"SELECT * REPLACE ({rnd('nivel', 6)} AS nivel) FROM nivel_serie",
    "forecast_horizon": "SELECT * FROM prevista",
    "features": f"""
        SELECT * REPLACE ({rnd('media_7', 6)} AS media_7, {rnd('media_28', 6)} AS media_28,
                          {rnd('desv_14', 6)} AS desv_14,
                          {rnd('dias_cobertura', 6)} AS dias_cobertura) FROM variables""",
    "refreshed_features": f"""
        SELECT * REPLACE ({rnd('media_7', 6)} AS media_7, {rnd('media_28', 6)} AS media_28,
                          {rnd('desv_14', 6)} AS desv_14,
                          {rnd('dias_cobertura', 6)} AS dias_cobertura) FROM variables""",
    "labels_next7": "SELECT fecha, tienda_id, sku, etiqueta FROM variables",
    "split_counts": """
        SELECT c AS corte, count(*) FILTER (fecha <= c) AS entrenamiento,
               count(*) FILTER (fecha > c) AS prueba
        FROM variables, corte WHERE etiqueta IS NOT NULL GROUP BY c""",
    "class_balance": f"""
        SELECT t AS entrenamiento, p AS positivos, p > 0 AND p < t AS entrenable,
               {rnd('CASE WHEN p > 0 AND p < t THEN (t - p) / p END', 6)} AS peso_positivos
        FROM (SELECT count(*) AS t, count(*) FILTER (etiqueta = 1) AS p
              FROM variables, corte WHERE etiqueta IS NOT NULL AND fecha <= c)""",
    "rule_auc": _auc("prueba", "lead_time - dias_cobertura"),
    "stump_nodes": """
        SELECT arbol, 0::INT AS nodo, arbol AS variable, umbral, 1::INT AS izquierda, 2::INT AS derecha,
               NULL::DOUBLE AS p FROM tocones
        UNION ALL
        SELECT arbol, hoja, NULL, NULL, NULL, NULL, CASE hoja WHEN 1 THEN p1 ELSE p2 END
        FROM tocones, (SELECT unnest([1::INT, 2::INT]) AS hoja)""",
    "stump_probability": """
        SELECT fecha, tienda_id, sku, probabilidad FROM puntuadas WHERE fecha = (SELECT d FROM ultimo)""",
    "stump_auc": _auc(
        "puntuadas", "probabilidad"
    ).replace("FROM puntuadas)", "FROM puntuadas WHERE etiqueta IS NOT NULL AND fecha > (SELECT c FROM corte))"),
    "rule_baseline": f"""
        SELECT *, coalesce({rnd('vp_regla / nullif(vp_regla + fp_regla, 0)', 4)}, 0) AS precision_regla,
               coalesce({rnd('vp_regla / nullif(vp_regla + fn_regla, 0)', 4)}, 0) AS recall_regla
        FROM regla""",
    "model_report_fixed": f"""
        SELECT 'regla' AS parte, nombre, valor FROM (
            UNPIVOT (SELECT CAST(vp_regla AS DOUBLE) AS vp_regla, CAST(fp_regla AS DOUBLE) AS fp_regla,
                CAST(fn_regla AS DOUBLE) AS fn_regla,
                coalesce({rnd('vp_regla / nullif(vp_regla + fp_regla, 0)', 4)}, 0) AS precision_regla,
                coalesce({rnd('vp_regla / nullif(vp_regla + fn_regla, 0)', 4)}, 0) AS recall_regla
              FROM regla) ON COLUMNS(*) INTO NAME nombre VALUE valor)
        UNION ALL
        SELECT 'pronostico', nombre, valor FROM (
            UNPIVOT (SELECT CAST(observaciones AS DOUBLE) AS observaciones, mae_base, mae_modelo, wape_modelo
              FROM errores) ON COLUMNS(*) INTO NAME nombre VALUE valor)
        UNION ALL
        SELECT 'clases', 'peso_positivos',
               {rnd('CASE WHEN p > 0 AND p < t THEN (t - p) / p END', 6)}
        FROM (SELECT count(*) AS t, count(*) FILTER (etiqueta = 1) AS p
              FROM variables, corte WHERE etiqueta IS NOT NULL AND fecha <= c)""",
    "demand_dispersion": f"""
        SELECT tienda_id, sku, {rnd('stddev_samp(unidades)', 6)} AS desviacion
        FROM hecho GROUP BY ALL""",
    "safety_stock": f"SELECT * REPLACE ({rnd('desviacion', 6)} AS desviacion) FROM situacion",
    "alerts": "SELECT * FROM avisos",
    "risk_fact": "SELECT * FROM riesgo",
    "risk_by_level": "SELECT nivel, count(*) AS n FROM riesgo WHERE horizonte = 7 GROUP BY 1",
    "kpi_risk": "SELECT * FROM kpi_riesgo",
    "kpi_stockout_rate": "SELECT * FROM kpi_quiebre",
    "kpi_streaming": "SELECT * FROM kpi_flujo",
    "kpis": """
        SELECT d AS fecha, calidad_pct, criticas, altas, medias, valor_en_riesgo, tasa_quiebre_pct,
               ventas_streaming, latencia_ingesta_seg, antiguedad_dato_seg
        FROM ultimo, calidad, kpi_riesgo, kpi_quiebre, kpi_flujo""",
    "alerts_export": f"SELECT {_ALERT_COLS} FROM {_FOUND}",
    "alerts_topk": f"SELECT {_SEARCH_COLS} FROM {_FOUND} LIMIT 50",
    "alerts_store_critical": f"""
        SELECT {_SEARCH_COLS} FROM riesgo
        WHERE horizonte = 14 AND nivel = 'CRITICO' AND tienda_id = 'T02'
        ORDER BY prioridad DESC, tienda_id, sku LIMIT 500""",
    "alerts_by_store_level": f"""
        SELECT tienda, nivel, count(*) AS alertas
        FROM riesgo WHERE horizonte = 7 AND nivel <> 'OK' GROUP BY ALL""",
    "impact_totals": f"""
        SELECT dias, (SELECT count(*) FROM locales) AS tiendas,
               (SELECT count(*) FROM catalogo) AS productos, demandadas, vendidas, no_atendidas,
               {rnd('no_atendidas * 100 / nullif(demandadas, 0)', 2)} AS pct_no_atendido,
               {rnd('hecha', 2)} AS venta_realizada_bruta, {rnd('perdida', 2)} AS venta_perdida,
               {rnd('perdida * 100 / nullif(hecha, 0)', 2)} AS perdida_pct,
               {rnd('365 / dias', 2)} AS factor_anual,
               {rnd('hecha * (365 / dias)', 2)} AS venta_realizada_anual,
               {rnd('perdida * (365 / dias)', 2)} AS venta_perdida_anual
        FROM (SELECT count(DISTINCT fecha) AS dias, CAST(sum(demanda) AS BIGINT) AS demandadas,
                     CAST(sum(vendidas) AS BIGINT) AS vendidas,
                     CAST(sum(no_atendidas) AS BIGINT) AS no_atendidas,
                     sum(valor_no_atendido) AS perdida FROM existencias),
             (SELECT sum(unidades * precio) AS hecha FROM historia)""",
    "lost_by_store": f"""
        SELECT tienda_id, lead_time, coalesce({rnd('sum(valor_no_atendido)', 2)}, 0) AS venta_perdida
        FROM locales LEFT JOIN existencias USING (tienda_id) GROUP BY ALL""",
    "lost_by_category_top5": f"""
        SELECT category, {rnd('sum(valor_no_atendido)', 2)} AS venta_perdida
        FROM existencias JOIN catalogo USING (sku) GROUP BY 1
        ORDER BY venta_perdida DESC, category LIMIT 5""",
    "stockout_rate": f"""
        SELECT count(*) FILTER (quiebre) AS en_quiebre, count(*) AS observaciones,
               {rnd('count(*) FILTER (quiebre) * 100 / nullif(count(*), 0)', 2)} AS tasa_quiebre_pct
        FROM existencias""",
    "stream_ingest": f"""
        SELECT {_SALE_COLS}, particion, offset_kafka FROM eventos WHERE sku <> 'error'""",
    "stream_quarantine": "SELECT particion, offset_kafka FROM eventos WHERE sku = 'error'",
    "stream_dedup": """
        SELECT venta_id, momento, sku, precio, 'ok' AS estado, CAST(NULL AS BIGINT) AS offset_kafka
        FROM eventos WHERE sku <> 'error' AND offset_kafka % 7 <> 0
        UNION ALL
        SELECT NULL, CASE WHEN sku <> 'error' THEN momento END,
               CASE WHEN sku <> 'error' THEN sku END, CASE WHEN sku <> 'error' THEN precio END,
               CASE WHEN sku = 'error' THEN 'cuarentena' ELSE 'ok' END, o
        FROM (SELECT *, unnest([offset_kafka, -offset_kafka - 1]) AS o FROM eventos)
        WHERE sku = 'error' OR offset_kafka % 7 = 0""",
    "stream_log": f"""
        SELECT {_SALE_COLS}, particion, offset_kafka, recibido FROM entregas WHERE sku <> 'error'""",
    "stream_preferred": f"""
        SELECT venta_id, momento - to_seconds(CAST(segunda AS INTEGER)) AS momento, tienda_id, sku, unidades,
               precio, importe, particion, 2 * offset_kafka + segunda AS offset_kafka,
               momento + to_minutes(CAST(5 * segunda AS INTEGER)) AS recibido, 'ok' AS estado,
               CAST(2 AS BIGINT) AS entregas
        FROM (SELECT *, CASE WHEN offset_kafka % 3 = 0 THEN 1 ELSE 0 END AS segunda FROM eventos)
        WHERE sku <> 'error'
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, particion, 2 * offset_kafka + n,
               momento + to_minutes(CAST(5 * n AS INTEGER)), 'cuarentena', 1
        FROM eventos, (VALUES (0), (1)) AS veces(n) WHERE sku = 'error'""",
    "stream_latency": "SELECT * FROM latencia",
    "stream_latency_total": f"""
        SELECT coalesce(CAST(sum(ventas) AS BIGINT), 0) AS ventas,
               {rnd('sum(espera_us) / (nullif(sum(medidas), 0) * 1000000)', 6)} AS latencia_seg,
               max(espera_max_us) / 1000000 AS latencia_max_seg, max(ultima_venta) AS ultima_venta
        FROM latencia""",
    "stream_replay": f"""
        SELECT {_SALE_COLS}, particion, offset_kafka, recibido FROM entregas WHERE sku = 'error'""",
}


def oracle_sql() -> dict[str, str]:
    """Every twin as one statement with the steps it needs in front."""
    return {name: _statement(body) for name, body in QUERIES.items()}


def _statement(body: str) -> str:
    needed = _mentioned(body)
    steps = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {steps}\n{body}" if steps else body


def _mentioned(text: str) -> set[str]:
    """Steps a text names, and the steps those name in turn."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & CTES.keys()) - found
        found |= new
        pending += [CTES[n] for n in new]
    return found
