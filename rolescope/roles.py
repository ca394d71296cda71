"""Column roles: which column of a table plays which part in a report."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Roles:
    """Names of the columns an operator works on.

    ``label_values`` lists the classes of ``label``. Listing them keeps crosstabs to one
    aggregate (no job to discover the pivot values) and bounds every per-class result.
    """

    id: tuple[str, ...] = ()
    label: str | None = None
    label_values: tuple[int, ...] = ()
    start_time: str | None = None
    end_time: str | None = None
    state: str | None = None
    county: str | None = None
    city: str | None = None
    condition: str | None = None
    extent: str | None = None
    numeric: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    forbidden: tuple[str, ...] = ()

    def but(self, **changes) -> "Roles":
        """A copy with some roles changed."""
        return replace(self, **changes)

    def need(self, *names: str) -> tuple:
        """Values of the named roles; raises when one is not set."""
        values = tuple(getattr(self, n) for n in names)
        unset = [n for n, v in zip(names, values) if v in (None, ())]
        if unset:
            raise ValueError(f"roles not set: {', '.join(unset)}")
        return values
