"""Values inside the JSON text of an action's arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where the ledger keeps each value.
DEPOSIT_FIELD = "deposit"
CODE_HASH = "$.code_sha256"
PERMISSION_KIND = "$.access_key.permission.permission_kind"
PERMITTED_CONTRACT = "$.access_key.permission.permission_details.receiver_id"

#: The values that statistics read, by the column that holds one where arguments are parsed.
ARGUMENTS = {
    "args_deposit": DEPOSIT_FIELD,
    "args_code_sha256": CODE_HASH,
    "args_permission_kind": PERMISSION_KIND,
    "args_permitted_contract": PERMITTED_CONTRACT,
}


def argument(path: str, args: str = "args") -> Column:
    """Text at a JSON path; NULL where the path is missing or holds JSON null."""
    return F.get_json_object(F.col(args), path)


def parsed(actions: DataFrame, names: Sequence[str]) -> DataFrame:
    """The actions with columns of `ARGUMENTS`.

    The deposit is both filtered on and summed. `json_tuple` generates its column, so the text
    is parsed once for both.
    """
    paths = {name: ARGUMENTS[name] for name in names}
    fields = {name: path for name, path in paths.items() if not path.startswith("$")}
    rows = actions.withColumns({n: argument(p) for n, p in paths.items() if n not in fields})
    for name, field in fields.items():
        rows = rows.select("*", F.json_tuple("args", field).alias(name))
    return rows
