"""What a simulated user answers, what a tool call is summed up as, and short forms of arguments and results, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions import text

# Names of the profile that answers by rule.
HYBRID = ["hybrid", "hybrid_live", "quota_saver", "fast"]


def is_hybrid(profile: Column) -> Column:
    return F.replace(F.lower(F.trim(profile)), F.lit("-"), F.lit("_")).isin(HYBRID)


def user_reply(said: Column, missing: Column, made: Column, expected: Column) -> Column:
    """To a question the missing details (an array of parameter names), else consent while calls are left, else thanks."""
    detail = F.concat(F.lit("Please use "), text.join_naturally(F.transform(missing, text.parameter_label)), F.lit(" as you see fit."))
    asked = F.when(F.size(missing) > 0, detail).otherwise("Whatever looks best is fine. Please go ahead.")
    return F.when(F.coalesce(said, F.lit("")).contains("?"), asked).when(made < expected, "Yes, please go ahead with that.").otherwise("Thanks, that covers what I needed.")


def tool_summary(reference: Column, made: Column, expected: Column) -> Column:
    named = F.coalesce(F.nullif(reference, F.lit("")), F.lit("the returned result"))
    done = F.concat(F.lit("Done, that is taken care of. Your reference is "), named, F.lit("."))
    return F.when(made >= expected, done).otherwise(F.concat(F.lit("I found the details I needed and will use reference "), named, F.lit(" to continue.")))


def is_over(made: Column, expected: Column) -> Column:
    """A conversation ends once all expected calls are made; nothing that is said changes this."""
    return made >= expected


def listed(items: Column, most: int) -> Column:
    """The first ``most`` of an array, and how many more there are; none for an empty one."""
    rest = F.size(items) - most
    return F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, "none").otherwise(F.concat(F.array_join(F.slice(items, 1, most), ","), F.when(rest > 0, F.concat(F.lit("+"), rest.cast("string"))).otherwise("")))
