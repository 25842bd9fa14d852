"""What a feature table is made of: one declaration shared by fitting and scoring."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T


def family(prefix: str, first: int, last: int, pad: int = 0) -> tuple[str, ...]:
    """Names of a numbered column family, both ends included.

    ``family("V", 12, 14)`` gives ``V12 V13 V14``; ``pad=2`` gives ``id_01``.
    """
    return tuple(f"{prefix}{i:0{pad}d}" for i in range(first, last + 1))


@dataclass(frozen=True)
class Block:
    """Numeric columns that are imputed, scaled and (with ``components``) projected together."""

    name: str
    columns: tuple[str, ...]
    components: int | None = None

    @property
    def assembled(self) -> str:
        return f"{self.name}_cols"

    @property
    def scaled(self) -> str:
        return f"{self.name}_scaled"

    @property
    def output(self) -> str:
        return f"{self.name}_pca" if self.components else self.scaled


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the input columns.

    ``features`` is laid out as: logged amounts, then the blocks in the order
    given, then one one-hot block per category column.
    """

    key: str
    label: str
    amounts: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    blocks: tuple[Block, ...] = field(default_factory=tuple)
    key_type: str = "bigint"

    def __post_init__(self) -> None:
        names = [self.key, self.label, *self.amounts, *self.categories, *self.block_columns]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"columns with more than one role: {', '.join(repeated)}")
        for block in self.blocks:
            if block.components and block.components > len(block.columns):
                raise ValueError(
                    f"block {block.name}: {block.components} components from {len(block.columns)} columns"
                )

    @property
    def block_columns(self) -> tuple[str, ...]:
        return tuple(c for block in self.blocks for c in block.columns)

    @property
    def inputs(self) -> tuple[str, ...]:
        return (*self.amounts, *self.categories, *self.block_columns)

    def logged(self) -> list[str]:
        return [f"{c}_log" for c in self.amounts]

    def indexed(self) -> list[str]:
        return [f"{c}_idx" for c in self.categories]

    def imputed_index(self) -> list[str]:
        return [f"{c}_nan" for c in self.categories]

    def encoded(self) -> list[str]:
        return [f"{c}_enc" for c in self.categories]

    def imputed(self) -> list[str]:
        return [f"{c}_nan" for c in self.block_columns]

    def types(self) -> dict[str, T.DataType]:
        """Column types to read with: categories stay text, so that a value is
        spelled the same in every file."""
        return {
            self.key: T.StructType.fromDDL(f"k {self.key_type}")["k"].dataType,
            self.label: T.IntegerType(),
            **{c: T.DoubleType() for c in self.amounts},
            **{c: T.StringType() for c in self.categories},
            **{c: T.DoubleType() for c in self.block_columns},
        }

    def without(self, columns: set[str]) -> FeatureSpec:
        """The same spec with some block columns left out. A block must keep as many columns as it has components."""
        blocks = []
        for block in self.blocks:
            kept = tuple(c for c in block.columns if c not in columns)
            if block.components and len(kept) < block.components:
                raise ValueError(
                    f"block {block.name}: {block.components} components, but only {len(kept)} columns with values"
                )
            if kept:
                blocks.append(Block(block.name, kept, block.components))
        return FeatureSpec(self.key, self.label, self.amounts, self.categories, tuple(blocks), self.key_type)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FeatureSpec:
        raw = json.loads(text)
        raw["blocks"] = tuple(Block(b["name"], tuple(b["columns"]), b["components"]) for b in raw["blocks"])
        raw["amounts"] = tuple(raw["amounts"])
        raw["categories"] = tuple(raw["categories"])
        return cls(**raw)
