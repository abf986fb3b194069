"""All queries of this package and their check SQL."""

from tidemark.llm import (  # noqa: F401
    codes,
    exact,
    licenses,
    lines,
    minhash,
    mixing,
    packing,
    phrases,
    rules,
    secrets,
    tokens,
    toxic,
    weak,
)
from tidemark.llm.shared import CHECKS, QUERIES  # noqa: F401
