"""Hash, id and bucket columns.

A stable hash is the SHA-256 of a struct's JSON with sorted keys, nulls kept, in ASCII. Column structs must name their
fields in alphabetical order at each level. `stable_hash_py` is the same over Python values.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_hash_py(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def ascii_json(value: Column) -> Column:
    """A struct's JSON as Python's json.dumps writes it: nulls kept, what isn't printable ASCII as \\u and four hex digits in
    lower case. Texts of printable ASCII, the usual case, are only looked at."""

    def spelt(text: Column) -> Column:
        lower = text
        for digit in "ABCDEF":  # of control characters, which to_json writes in upper case
            lower = F.regexp_replace(lower, rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}", rf"$1{digit.lower()}")
        code = lambda c: F.lower(F.hex(F.encode(c, "UTF-16BE")))
        wide = lambda c: F.concat(F.lit("\\u"), F.substring(code(c), 1, 4), F.when(F.length(code(c)) > 4, F.concat(F.lit("\\u"), F.substring(code(c), 5, 4))).otherwise(""))
        letters = F.transform(F.regexp_extract_all(lower, F.lit("(?s)."), 0), lambda c: F.when(c.rlike("[ -~]"), c).otherwise(wide(c)))
        return F.when(text.rlike(r"[^ -~]|\\u00"), F.array_join(letters, "")).otherwise(text)

    # Bound by transform, so that the struct's expression stands in the plan once.
    return F.element_at(F.transform(F.array(F.to_json(value, {"ignoreNullFields": "false"})), spelt), 1)


def stable_hash(**fields: Column) -> Column:
    ordered = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return F.sha2(ascii_json(ordered), 256)


def row_id(namespace: Column, family: Column, number: Column) -> Column:
    """Zero-padded to six digits, never cut."""
    return F.format_string("%s_%s_%06d", namespace, family, number)


def versioned(name: Column, version: Column) -> Column:
    return F.concat_ws("_", name, version)


def exact_row_key() -> Column:
    return stable_hash(dialect=F.col("dialect"), schema=F.col("db_schema_id"), source_sql=F.col("source_sql"), target_sql=F.col("target_sql"), task=F.col("task"))


def template_family_key(schema_family: str = "schema_family", template_id: str = "template_id") -> Column:
    return stable_hash(schema_family=F.col(schema_family), template_id=F.col(template_id))


def same_template_family(one: str, two: str) -> Column:
    """Whether two rows, given as struct columns, are of one template family."""
    return template_family_key(f"{one}.schema_family", f"{one}.template_id") == template_family_key(f"{two}.schema_family", f"{two}.template_id")


def semantic_hash(schema_id: Column, template_id: Column, task: Column, program_hash: Column) -> Column:
    return stable_hash(program_hash=program_hash, schema_id=schema_id, task=task, template_id=template_id)


def exact_audit_key() -> Column:
    """Unlike exact_row_key, a null target equals an empty one."""
    return F.concat_ws("|", "task", "db_schema_id", "source_sql", F.coalesce("target_sql", F.lit("")), "dialect")


def split_bucket(group_key: Column) -> Column:
    """0 to 99, from the first 32 bits of the hash of the group key."""
    return F.conv(F.substring(stable_hash(group_key=group_key), 1, 8), 16, 10).cast("long") % 100
