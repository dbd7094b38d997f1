"""Status codes, their labels and the sets built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order status code to label.
STATUS_LABELS = {
    1: "NUEVA ORDEN",
    5: "PENDIENTE DE AUDITORÍA",
    6: "AUDITORÍA RECHAZADA",
    9: "PENDIENTE DE PICKING EN EL SELLER",
    10: "PENDIENTE DE PICKING",
    11: "PENDIENTE DE REPICKING",
    20: "EN PICKING",
    21: "PENDIENTE DE FINALIZAR PICKING",
    22: "FINALIZANDO PICKING",
    23: "PREPICKING",
    25: "PREPICKING",
    30: "PICKEADO POR FACTURAR",
    33: "PROCESANDO DESCUENTOS",
    35: "PRECANCELADA",
    40: "FACTURADO",
    50: "A RECUPERAR",
    60: "LISTO PARA ENVIAR",
    65: "LISTO PARA RETIRAR",
    66: "ESPERANDO POR LOGISTICA EXTERNA",
    70: "DESPACHADO",
    80: "A REPROGRAMAR ENTREGA",
    90: "ENTREGADO",
    95: "LIQUIDADO",
    100: "ANULADO",
    105: "ANULACIÓN AUTOMÁTICA PENDIENTE",
    110: "ANULACIÓN CONFIRMADA",
    120: "CANCELACIÓN PENDIENTE",
    125: "CANCELADO",
    130: "DEVOLUCIÓN PARCIAL",
    135: "DEVOLUCIÓN TOTAL",
}

# Labels that count as picked, dispatched and delivered.
PICKED = (
    "EN PICKING",
    "PENDIENTE DE FINALIZAR PICKING",
    "FINALIZANDO PICKING",
    "PREPICKING",
    "PICKEADO POR FACTURAR",
    "PROCESANDO DESCUENTOS",
    "PRE CANCELADO",
    "FACTURADO",
    "PENDIENTE SAC",
    "LISTO PARA ENVIAR",
    "LISTO PARA RETIRAR",
    "DESPACHADO",
    "A REPROGRAMAR ENTREGA",
    "ENTREGADO",
    "LIQUIDADO",
)
DISPATCHED = ("DESPACHADO", "A REPROGRAMAR ENTREGA", "ENTREGADO", "LIQUIDADO")
DELIVERED = ("ENTREGADO", "LIQUIDADO")
PICKED_FOR_STOCKOUT = (
    "PICKEADO POR FACTURAR",
    "PROCESANDO DESCUENTOS",
    "PRE CANCELADO",
    "FACTURADO",
    "PENDIENTE SAC",
    "LISTO PARA ENVIAR",
    "LISTO PARA RETIRAR",
    "DESPACHADO",
    "A REPROGRAMAR ENTREGA",
    "ENTREGADO",
    "LIQUIDADO",
)

# Grouped labels and the codes the picking report leaves out.
VOIDED = "ANULADO"
VOIDED_AND_RETURNED = "ANULADO Y DEVOLUCIONES"
UNKNOWN_STATUS = "POR IDENTIFICAR"
SOLD_GROUPS = ("ENTREGADO", "EN PROCESO")
PROMOTED_GROUPS = ("ENTREGADO", "EN PROCESO", "PENDIENTE DE PICKING")
NOT_PICKED_CODES = (135, 132, 130, 125, 120, 110, 105, 100, 35, 20, 25)


def code_label(code: Column, table: dict[int, str] = STATUS_LABELS) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), code)


def label_in(label: Column, members: tuple[str, ...]) -> Column:
    """1 when the upper-cased label is a member, else 0; a null label counts as 0."""
    return F.when(F.upper(label).isin(list(members)), F.lit(1)).otherwise(F.lit(0))


def grouped_status(group: Column) -> Column:
    """Voided orders join the returns; a missing group gets its own name."""
    return (
        F.when(group == VOIDED, F.lit(VOIDED_AND_RETURNED))
        .when(group.isNull(), F.lit(UNKNOWN_STATUS))
        .otherwise(group)
    )


def classify(rules: list[tuple[Column, str]], default: str | None = None) -> Column:
    """First matching rule wins."""
    if not rules:
        return F.lit(default)
    chain = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, value in rules[1:]:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))
