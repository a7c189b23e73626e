"""Text shaping for prompts, labels and messages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions.classify import first_match

# Fixed values.
SOFTER = {"get ": "look up ", "create ": "set up ", "book ": "book ", "reserve ": "reserve ", "search ": "look for ", "find ": "find ", "list ": "review ", "update ": "update ", "cancel ": "cancel ", "delete ": "remove "}
NOTHING = "get something handled"
#: Words of the tooling that prose shouldn't show, as patterns, and what stands for them.
PLAIN_WORDS = [(r"(?i)\bAPIs?\b", "service"), (r"(?i)\bendpoints\b", "options"), (r"(?i)\bendpoint\b", "option"), (r"(?i)\btools\b", "steps"), (r"(?i)\btool\b", "step")]


def collapse(text: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def shorten(text: Column, most: int) -> Column:
    """Collapsed text of at most ``most`` characters, with three dots where cut."""
    t = collapse(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 3)), F.lit("...")))


def ellipsis(text: Column, most: int) -> Column:
    t = collapse(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - 1)), F.lit("…")))


def shorten_at_sentence(text: Column, most: int, cut: int = 3) -> Column:
    """Cut after the last sentence end before ``most`` if that is in the second half, else hard with three dots."""
    t = collapse(text)
    head = F.substring(t, 1, most)
    back = F.reverse(head)
    last = [F.when(F.instr(back, mark[::-1]) > 0, most - F.instr(back, mark[::-1]) - 1).otherwise(-1) for mark in (". ", "? ", "! ")]
    at = F.greatest(*last)
    return F.when(F.length(t) <= most, t).when(at >= most // 2, F.substring(t, F.lit(1), at + 1)).otherwise(F.concat(F.rtrim(F.substring(t, 1, most - cut)), F.lit("...")))


def soften(phrase: Column) -> Column:
    cases = [(phrase.startswith(a), F.concat(F.lit(b), F.substring(phrase, F.lit(len(a) + 1), F.length(phrase)))) for a, b in SOFTER.items()]
    return first_match(cases, F.when(phrase == "", NOTHING).otherwise(phrase))


def natural_task(name: Column, description: Column) -> Column:
    """What an endpoint does, in a user's words."""
    said = F.lower(F.regexp_replace(F.trim(description), r"\.+$", ""))
    named = F.lower(F.trim(F.replace(name, F.lit("_"), F.lit(" "))))
    return F.when(name.isNull(), NOTHING).when(F.coalesce(description, F.lit("")) != "", soften(said)).otherwise(soften(F.when(named == "", NOTHING).otherwise(named)))


def step_goal(name: Column, description: Column, endpoint_id: Column, step: Column, total: Column) -> Column:
    prefix = F.format_string("Step %d/%d", step, F.greatest(step, total))
    said = F.trim(F.coalesce(description, F.lit("")))
    return F.concat(prefix, F.lit(": "), F.when(said != "", said).otherwise(F.concat(F.lit("call "), F.coalesce(F.replace(name, F.lit("_"), F.lit(" ")), endpoint_id))))


def parameter_label(name: Column) -> Column:
    n = F.lower(name)
    plain = F.replace(n, F.lit("_"), F.lit(" "))
    return first_match(
        [
            (n.isin("id", "item_id", "resource_id"), F.lit("reference")),
            (n.isin("order_id", "order_number"), F.lit("order number")),
            (n.isin("booking_id", "reservation_id", "confirmation_id"), F.lit("confirmation reference")),
            (n.endswith("_id"), F.concat(F.regexp_replace(plain, " id$", ""), F.lit(" reference"))),
            (n.isin("check_in", "checkin"), F.lit("check-in date")),
            (n.isin("check_out", "checkout"), F.lit("check-out date")),
            (n == "max_price", F.lit("budget")),
            (n == "email", F.lit("email address")),
        ],
        plain,
    )


def user_detail(name: Column, value: Column) -> Column:
    n = F.lower(name)
    return F.when(n.contains("currency"), F.concat(F.lit("Please use "), value)).when(n.contains("email"), F.concat(F.lit("The email address is "), value)).otherwise(F.concat(F.lit("The "), parameter_label(name), F.lit(" is "), value))


def join_naturally(items: Column) -> Column:
    """a; a and b; a, b, and c; 'details' for none."""
    n = F.size(items)
    return F.when(n == 0, "details").when(n <= 2, F.array_join(items, " and ")).otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(", and "), F.element_at(items, -1)))


def join_sentences(items: Column) -> Column:
    cleaned = F.filter(F.transform(items, lambda x: F.regexp_replace(F.trim(x), r"\.+$", "")), lambda x: x != "")
    return F.when(F.size(cleaned) == 0, "I can share whatever details you need.").otherwise(F.concat(F.array_join(cleaned, ". "), F.lit(".")))


def sanitize(text: Column, names: Column) -> Column:
    """Prose without identifiers: ``names`` is an array of (raw, plain) pairs, replaced in order and in any case."""
    quoted = lambda x: F.concat(F.lit("(?i)"), F.regexp_replace(x, r"([^\p{L}\p{N}\s])", r"\\$1"))
    safe = lambda x: F.regexp_replace(x, r"([\\$])", r"\\$1")
    out = F.aggregate(names, text, lambda acc, x: F.when(x["raw"] == "", acc).otherwise(F.regexp_replace(acc, quoted(x["raw"]), safe(x["plain"]))))
    for pattern, plain in PLAIN_WORDS:
        out = F.regexp_replace(out, pattern, plain)
    return collapse(out)


def safe_name(name: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}\-_.]", "_"), r"^[._]+|[._]+$", "")
    return F.when(bare == "", "unnamed").otherwise(bare)


def safe_path(path: Column) -> Column:
    """A relative path of safe parts, without empty, . and .. ones."""
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", ".", ".."))
    return F.when(F.size(parts) == 0, "unnamed.json").otherwise(F.array_join(F.transform(parts, safe_name), "/"))


def diagram_label(text: Column, most: int = 80) -> Column:
    """Shortened, with brackets and quotes that diagrams can show."""
    return F.translate(shorten(text, most), "\"[]{}", "'()()")
