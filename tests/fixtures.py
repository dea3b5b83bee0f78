"""Small hand-written staging tables of G2, G3 and G4."""

from datetime import date, datetime
from decimal import Decimal

from yardstar.schemas import staging_schema

T = datetime


def frames(spark):
    d = Decimal
    rows = {
        "g2_patio": [(1, " Centro ", "Rua A", 10), (2, "norte", "Rua B", 5)],
        "g2_grupo": [(1, "EC", "Economico", " basico ", d("100.00"), 50)],
        "g2_veiculo": [
            (1, 1, 1, "AAA1", "C1", "M", "X", "Azul", 2020, " automatica", True, 10, "DISPONIVEL"),
            (2, 1, 2, "AAA2", "C2", "M", "X", "Azul", 2021, "Manual", False, 20, "MANUTENCAO"),
        ],
        "g2_cliente": [
            (1, "PF", "Ana", "a@x", "1", " rio ", "11111111111", date(1990, 1, 1), None),
            (2, "PJ", "Firma", "f@x", "2", "Niterói", None, None, "22222222222222"),
        ],
        "g2_reserva": [
            (1, 1, 1, 1, 2, T(2026, 1, 1, 8), T(2026, 1, 2, 8), T(2026, 1, 6, 9), "CONFIRMADA"),
            (2, 2, 1, 2, 9, T(2026, 1, 1, 8), T(2026, 1, 3, 8), T(2026, 1, 4, 7), "EM_FILA_ESPERA"),
        ],
        "g2_locacao": [
            (1, 1, 1, 1, 1, 2, T(2026, 1, 2, 8), T(2026, 1, 5, 9), 100, 150, d("90.00"), " concluida"),
            (2, None, 2, 2, 2, 2, T(2026, 1, 3, 8), None, 100, None, d("80.00"), "Em_Andamento "),
            (3, 2, 2, 1, 1, 1, T(2026, 1, 3, 8), T(2026, 1, 3, 20), 7, 9, d("70.00"), "CANCELADA"),
            (4, 77, 2, 1, 1, 1, T(2040, 1, 3, 8), T(2040, 1, 4, 8), 7, 9, d("70.00"), "CONCLUIDA"),
        ],
        "g3_patio": [(1, "Sul", 5, "Locadora S", " rio ", "rj"), (2, "Leste", 5, "Locadora S", "niterói", "rj")],
        "g3_grupo": [(1, "Luxo", "Carros de luxo", d("300.00"))],
        "g3_veiculo": [
            (1, 1, "SUV", "M", "X", "2019", "Azul", "C" * 17, "AAA0001", True, True),
            (2, 1, "SUV", "M", "X", "2020", "Azul", "D" * 17, "AAA0002", True, False),
            (3, 1, "SUV", "M", "X", None, "Azul", "E" * 17, "AAA0003", False, None),
        ],
        "g3_cliente": [(1, "Bia", "33333333333", "BR", " rio ", " rj")],
        "g3_reserva": [
            (i, 1, 1, 1, 2, T(2026, 2, 1, 8), T(2026, 2, 4, 8), date(2026, 1, 20), code, d("900.00"))
            for i, code in ((1, 0), (2, 1), (3, 2), (4, 7))
        ],
        "g3_locacao": [
            (1, 1, 1, 1, T(2026, 2, 1, 9)),
            (2, 2, 2, 1, T(2026, 2, 1, 9)),
            (3, 3, 3, 2, T(2026, 2, 1, 9)),
            (4, 99, 3, 2, T(2026, 2, 1, 9)),
        ],
        # Rental 1: its first return names an unknown slot. Rental 2: only that. Rental 3: none.
        "g3_devolucao": [
            (12, 1, 8, T(2026, 2, 9, 9)),
            (11, 1, 7, T(2026, 2, 3, 9)),
            (10, 1, 404, T(2026, 2, 2, 8)),
            (13, 2, 404, T(2026, 2, 5, 9)),
        ],
        "g3_vaga": [(7, "V7", 2), (8, "V8", 1)],
        "g4_patio": [(1, "P-01", 10, "08:00:00", "20:00:00", "rio", "rj", "Parceira A")],
        "g4_categoria": [
            (1, "Popular", "A", d("50.00"), False),
            (2, "Medio", "B", d("60.00"), False),
            (3, "Alto", "C", d("70.00"), False),
            (4, "Outro", "Z", d("80.00"), False),
        ],
        "g4_veiculo": [(1, "BBB1", "F1", "X", 2022, True, 5, d("55.00"), 1), (2, "BBB2", "F2", "X", 2022, True, 5, d("55.00"), 9)],
        "g4_motorista": [(1, "44444444444", "Caio", "123", "B", "niterói ", "rj")],
        "g4_reserva": [(1, T(2026, 3, 1, 8), T(2026, 3, 2, 8), "Confirmada")],
        "g4_locacao": [
            (1, d("55.00"), T(2026, 3, 2, 8), T(2026, 3, 2, 20), 1, 1, 1, 1, 1),
            (2, d("55.00"), T(2026, 3, 2, 8), None, 1, None, 1, 1, 1),
            (3, d("55.00"), T(2026, 3, 2, 8), T(2026, 3, 6, 8), 404, 1, 1, 1, 1),
            (4, d("55.00"), T(2026, 3, 2, 8), T(2026, 3, 6, 8), 1, 1, 2, 1, 1),
        ],
        "g4_vaga": [(1, "A1", 1)],
    }
    return {t: spark.createDataFrame(r, staging_schema(t)) for t, r in rows.items()}
