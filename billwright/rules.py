"""Business rules shared by the plans, with the defaults of the reported company."""

from __future__ import annotations

from dataclasses import dataclass

# The fiscal operation codes (CFOP) that mark a project sale.
PROJECT_CFOPS = ("5101", "5102", "5124", "5933", "6101", "6102", "6118", "6123", "6124", "6933")

# The texts a line's status can take ("Devolvida" carries a note number).
CANCELLED = "Cancelada"
RETURNED_BY = "Devolvida pela NF "
AWAITING = "Aguardando Aprovação"
AUTHORISED = "Autorizada"

# What a document is called, and a line without a product name.
SERVICE_DOCUMENT = "NFSe"
GOODS_DOCUMENT = "NF"
SERVICE_PRODUCT = "SERVIÇO"

# Flag for yes, stage of a won quote, prefix of excluded service orders.
YES = "X"
WON = "GANHOU"
EXCLUDED_ORDER_PREFIX = "e"


@dataclass(frozen=True)
class Rules:
    """What to report, and how much one task may hold.

    ``case_sensitive`` follows the collation of the source database: whether text
    that the view compares (order prefix, stage of a quote, guids) differs by case.
    Trailing blanks never count. ``collation`` names one of Spark's collations to compare by
    instead, for instance ``UNICODE_CI_AI_RTRIM``, which ignores accents too.
    ``rows_per_task`` is the number of rows of one join key up to which the key is
    never split over several tasks; beyond, it is if it exceeds an even share of the
    rows over ``join_tasks`` (by default the session's shuffle partitions).
    """

    company: int = 1
    cfops: tuple[str, ...] = PROJECT_CFOPS
    case_sensitive: bool = False
    collation: str | None = None
    rows_per_task: int = 100_000
    join_tasks: int | None = None
