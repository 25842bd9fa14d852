"""Ready-made specs."""

from __future__ import annotations

from evenkeel.spec import Block, FeatureSpec, family

# Column names and component counts of the card transaction tables.
TRANSACTION_CATEGORIES = (
    "ProductCD", "card1", "card2", "card3", "card4", "card5", "card6",
    "P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo",
)
V_COMPONENTS = 35
ID_COMPONENTS = 12


def card_transactions(with_id_block: bool = False) -> FeatureSpec:
    """Card transactions joined with device identity, labelled by ``isFraud``.

    The id block is known but left out unless asked for; it must be numeric.
    """
    blocks = [Block("v", family("V", 12, 338), V_COMPONENTS)]
    if with_id_block:
        blocks.append(Block("id", family("id_", 1, 37, pad=2), ID_COMPONENTS))
    blocks.append(Block("c", family("C", 1, 13)))
    return FeatureSpec(
        key="TransactionID",
        label="isFraud",
        amounts=("TransactionAmt",),
        categories=TRANSACTION_CATEGORIES,
        blocks=tuple(blocks),
    )
