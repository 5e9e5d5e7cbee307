"""Reading values of a parsed document by path.

``Node`` is a position in a document: a VARIANT column plus the path already walked. JSON null and an absent
key are different things to a table spec: null anywhere on a path gives NULL and satisfies a mandatory
column, only a missing key does not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweir.plans.spec import SpecError


def step_text(key: str) -> str:
    """One quoted step of a variant path."""
    if key == "":
        raise SpecError("empty step in a path")
    if "'" not in key:
        return f"['{key}']"
    if '"' not in key:
        return f'["{key}"]'
    raise SpecError(f"a key with both kinds of quotes cannot be addressed: {key!r}")


def split_path(path: str | None) -> list[str]:
    """Dotted text to steps; no path or ``$`` is the document itself."""
    return [] if path in (None, "", "$") else path.split(".")


@dataclass(frozen=True)
class Node:
    """A place in a variant column."""

    variant: Column
    base: str = "$"

    def path(self, keys) -> str:
        return self.base + "".join(step_text(k) for k in keys)

    def get(self, path, data_type: str = "string") -> Column:
        """The value at a dotted path (or list of steps); NULL when it is null, absent or not of that type."""
        keys = split_path(path) if path is None or isinstance(path, str) else list(path)
        return F.try_variant_get(self.variant, self.path(keys), data_type)

    def get_or(self, path, default, data_type: str = "string") -> Column:
        """Like ``get``, with a default for both null and absent."""
        return F.coalesce(self.get(path, data_type), F.lit(default).cast(data_type))

    def is_null(self, keys) -> Column:
        """The value is there and is JSON null."""
        return F.coalesce(F.is_variant_null(self.get(keys, "variant")), F.lit(False))

    def is_absent(self, keys) -> Column:
        """No such key, and no null on the way to it."""
        absent = self.get(keys, "variant").isNull()
        for n in range(len(keys)):
            absent = absent & ~self.is_null(keys[:n])
        return absent
