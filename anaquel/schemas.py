"""Explicit schemas of every input and landed table."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TEXT, _INT, _LONG, _NUMBER = StringType(), IntegerType(), LongType(), DoubleType()


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


PRODUCTO = _struct(
    id=_INT, title=_TEXT, sku=_TEXT, category=_TEXT, brand=_TEXT,
    price=_NUMBER, stock=_INT, minimumOrderQuantity=_INT,
)
CATALOGO = _struct(products=ArrayType(PRODUCTO))

OBSERVACION = _struct(FK_Periodo=_INT, Valor=_NUMBER)
SERIE_INDICE = _struct(Data=ArrayType(OBSERVACION))

TIENDA = _struct(tienda_id=_TEXT, nombre=_TEXT, tamano=_NUMBER, lead_time=_INT)
FACTOR_DIA = _struct(dia=_INT, factor=_NUMBER)

VENTA = _struct(
    venta_id=_TEXT, momento=TimestampType(), tienda_id=_TEXT, sku=_TEXT,
    unidades=_INT, precio=_NUMBER, importe=_NUMBER,
)
VENTA_STREAM = StructType(
    VENTA.fields + _struct(particion=_INT, offset_kafka=_LONG, recibido=TimestampType()).fields
)
VENTA_LANDED = StructType([*VENTA_STREAM.fields, StructField("estado", _TEXT)])
MENSAJE = _struct(
    mensaje=_TEXT, particion=_INT, offset_kafka=_LONG, recibido=TimestampType(), estado=_TEXT
)

INVENTARIO = _struct(
    fecha=DateType(), tienda_id=_TEXT, sku=_TEXT, stock=_INT, en_camino=_INT,
    quiebre=BooleanType(), demanda=_INT, vendidas=_INT, no_atendidas=_INT,
    valor_no_atendido=_NUMBER,
)
PROBABILIDAD = _struct(tienda_id=_TEXT, sku=_TEXT, probabilidad=_NUMBER)
METRICAS = _struct(
    auc=_NUMBER, precision=_NUMBER, recall=_NUMBER, precision_regla=_NUMBER, recall_regla=_NUMBER,
    vp=_LONG, fp=_LONG, fn=_LONG, vn=_LONG, peso_positivos=_NUMBER,
)
IMPORTANCIA = _struct(variable=_TEXT, importancia=_NUMBER)
CARGA = _struct(fecha=_TEXT, origen=_TEXT, fichero=_TEXT, registros=_LONG)
