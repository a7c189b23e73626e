"""Names and types of endpoints, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these words and on their order.
PARAMETER_TYPES = {
    "string": ["str", "string", "text"],
    "number": ["num", "number", "float", "double"],
    "integer": ["int", "integer", "long"],
    "boolean": ["bool", "boolean"],
    "array": ["list", "array"],
    "object": ["dict", "object", "json"],
}
METHODS = ["GET", "POST", "PUT", "DELETE", "PATCH"]
VERBS = {
    "search": ["search", "find", "list", "query", "browse", "lookup", "get_all", "fetch_all"],
    "get": ["get", "retrieve", "fetch", "show", "view", "read", "detail"],
    "create": ["create", "add", "new", "register", "post", "submit", "book", "reserve"],
    "update": ["update", "modify", "edit", "change", "patch", "set"],
    "delete": ["delete", "remove", "cancel", "revoke", "unregister"],
}
OPERATIONS = {
    "search": ["search", "find", "list", "query", "browse", "get_all"],
    "get": ["get", "retrieve", "fetch", "detail", "show", "view"],
    "delete": ["delete", "remove", "cancel", "revoke"],
    "create": ["create", "add", "new", "register", "book", "reserve", "post", "submit"],
    "update": ["update", "modify", "edit", "change", "patch", "set"],
}
NOUN_PREFIXES = ["get", "search", "find", "list", "create", "add", "update", "delete", "remove", "book", "fetch", "retrieve", "cancel", "post", "put"]
ENTITY_PREFIXES = ["search", "find", "list", "get", "create", "book", "reserve", "update", "delete", "cancel"]
#: Entity types in the order in which they are looked for, and the prefix of their ids.
ENTITIES = {
    "hotel": "htl", "flight": "flt", "restaurant": "rst", "car": "car", "booking": "bk", "reservation": "rsv", "order": "ord", "user": "usr",
    "product": "prd", "event": "evt", "ticket": "tkt", "review": "rev", "payment": "pmt", "location": "loc", "route": "rte", "movie": "mov",
    "song": "sng", "album": "alb", "artist": "art", "recipe": "rcp", "news": "nws", "weather": "wthr", "stock": "stk", "crypto": "cry",
}


def first_match(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    head, *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(*head)).otherwise(otherwise)


def parameter_type(raw: Column) -> Column:
    """The normal type of a raw one; a missing type is a string, an odd one unknown."""
    cleaned = F.lower(F.trim(raw))
    return first_match([(raw.isNull(), F.lit("string")), *((cleaned.isin(names), F.lit(kind)) for kind, names in PARAMETER_TYPES.items())], F.lit("unknown"))


def http_method(raw: Column) -> Column:
    cleaned = F.upper(F.trim(raw))
    return F.when(cleaned.isin(METHODS), cleaned).otherwise("GET")


def endpoint_id(tool: Column, endpoint: Column) -> Column:
    return F.concat(tool, F.lit("/"), endpoint)


def verb(name: Column) -> Column:
    """The verb group whose word begins the name, in any case; null if none does."""
    return first_match([(name.rlike(f"(?i)^({'|'.join(words)})"), F.lit(kind)) for kind, words in VERBS.items()], F.lit(None).cast("string"))


def operation(name: Column) -> Column:
    """The operation whose word the name has anywhere."""
    lowered = F.lower(name)
    return first_match([(lowered.rlike("|".join(words)), F.lit(kind)) for kind, words in OPERATIONS.items()], F.lit("generic"))


def singular(name: Column) -> Column:
    return F.when(name.endswith("ies"), F.concat(F.expr("''"), F.regexp_replace(name, "ies$", "y"))).when(name.endswith("s") & ~name.endswith("ss"), F.regexp_replace(name, "s$", "")).otherwise(name)


def noun(name: Column) -> Column:
    """What follows the verb prefix, in the singular."""
    return singular(F.regexp_replace(F.lower(name), f"^({'|'.join(NOUN_PREFIXES)})_", ""))


def entity_name(name: Column) -> Column:
    bare = F.regexp_replace(F.lower(name), f"^({'|'.join(ENTITY_PREFIXES)})_", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "_details$", ""), "_detail$", "")
    one = singular(bare)
    return F.when(one == "", "item").otherwise(one)


def entity_type(name: Column, description: Column) -> Column:
    """The first entity that name or description mention."""
    text = F.concat_ws(" ", F.lower(name), F.lower(description))
    return first_match([(text.contains(e), F.lit(e)) for e in ENTITIES], F.lit("item"))


def entity_prefix(kind: Column) -> Column:
    return first_match([(kind == e, F.lit(p)) for e, p in ENTITIES.items()], F.lit("itm"))


def chain_pattern(steps: Column, creates: Column, reads: Column, updates: Column, deletes: Column) -> Column:
    """Of a chain with so many steps; the others are boolean columns."""
    kinds = sum((c.cast("int") for c in (creates, reads, updates, deletes)), F.lit(0))
    return F.when(steps == 1, "single_step").when(kinds >= 3, "crud_cycle").when(reads & (creates | updates | deletes), "search_and_act").otherwise("multi_step")


def complexity(steps: Column) -> Column:
    return F.when(steps >= 3, "multi_step_with_disambiguation").when(steps > 1, "multi_step").otherwise("single_step")
