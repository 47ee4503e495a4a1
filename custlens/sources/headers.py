"""Mapping of file headers to canonical column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known French and English spellings of the canonical columns.
KNOWN_ALIASES: dict[str, list[str]] = {
    "order_id": ["id_commande", "commande_id", "num_commande"],
    "customer_id": ["client_id", "id_client", "customer", "client"],
    "order_date": ["date_commande", "date", "dateorder", "orderdate"],
    "amount": ["montant", "total", "prix_total", "total_ttc"],
    "price": ["prix", "prix_unitaire", "unit_price"],
    "quantity": ["quantite", "qte", "qty"],
}


def tidy_name(name: str) -> str:
    return str(name).strip().lower().replace(" ", "_")


def resolve_headers(
    headers: Sequence[str], expected: Sequence[str], aliases: Mapping[str, Sequence[str]] | None = None
) -> dict[str, str]:
    """canonical name -> header. Exact name first, then the aliases, then the first header that contains
    the name or is contained in it. Names nothing matches are left out."""
    aliases = KNOWN_ALIASES if aliases is None else aliases
    found: dict[str, str] = {}
    for target in map(tidy_name, expected):
        exact = [h for h in headers if h == target]
        listed = [a for a in aliases.get(target, ()) if a in headers]
        partial = [h for h in headers if target in h or h in target]
        choices = exact or listed or partial
        if choices:
            found[target] = choices[0]
    return found


def canonical_names(
    names: Sequence[str], expected: Sequence[str], aliases: Mapping[str, Sequence[str]] | None = None, on_conflict: str = "error"
) -> list[str]:
    """The names of columns after the mapping: canonical where something matches, else tidied.

    When two canonical names resolve to one column this is an error, or with ``on_conflict="last"`` the later
    name gets the column.
    """
    tidy = [tidy_name(c) for c in names]
    if len(set(tidy)) != len(tidy):
        raise ValueError(f"headers are not unique after tidying: {tidy}")
    new_name: dict[str, str] = {}
    for target, header in resolve_headers(tidy, expected, aliases).items():
        if header in new_name and on_conflict == "error":
            raise ValueError(f"{header!r} matches both {new_name[header]!r} and {target!r}")
        new_name[header] = target
    return [new_name.get(name, name) for name in tidy]


def canonicalise_columns(
    df: DataFrame,
    expected: Sequence[str],
    aliases: Mapping[str, Sequence[str]] | None = None,
    on_conflict: str = "error",
) -> DataFrame:
    """Rename columns to their canonical names (see ``canonical_names``) in one projection."""
    names = canonical_names(df.columns, expected, aliases, on_conflict)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])


def union_by_canonical_name(
    frames: Sequence[DataFrame], expected: Sequence[str], aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Files with different headers as one table; columns a file lacks are NULL."""
    named = [canonicalise_columns(f, expected, aliases) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
