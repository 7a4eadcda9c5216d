"""Feature definitions: which columns a model uses, as what type, in which role."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

# fixed values: the roles, data types and encoding strategies a feature definition may name
ROLES = ("feature", "target", "excluded", "identifier")
DATA_TYPES = ("bool", "int", "float", "str")
STRATEGIES = ("none", "one hot encoding", "hashing", "count_vectorizing", "tf_idf", "text_similarity", "scaling")

SQL_TYPES = {"bool": "boolean", "int": "bigint", "float": "double", "str": "string"}


@dataclass(frozen=True)
class Feature:
    name: str
    role: str = "feature"
    dtype: str = "float"
    strategy: str = "none"
    args: dict = field(default_factory=dict)

    def __post_init__(self):
        for value, allowed in ((self.role, ROLES), (self.dtype, DATA_TYPES), (self.strategy, STRATEGIES)):
            if value not in allowed:
                raise ValueError(f"{self.name}: {value!r} is not one of {allowed}")


def check_spec(spec: Sequence[Feature]) -> None:
    names = [f.name for f in spec]
    if len(set(names)) != len(names):
        raise ValueError("feature names must be unique")
    if sum(f.role == "identifier" for f in spec) > 1:
        raise ValueError("at most one feature can be the identifier")


def names_with(spec: Sequence[Feature], roles: Iterable[str]) -> list[str]:
    wanted = set(roles)
    return [f.name for f in spec if f.role in wanted]
