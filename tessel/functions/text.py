"""Column functions on states, ids, prices and reviews."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Composition modes, narrowest first.
MODES = ("pure_target", "light_context", "contextual", "environment_rich")
#: Modes under a measured limit.
LIMITED = ("pure_target", "light_context")
DEFAULT_NAMESPACE = "minecraft"


def block_state(state: Column) -> Column:
    """``namespace:name[property=value,...]`` with a default namespace and sorted properties; null if malformed."""
    full = F.when(F.instr(F.regexp_extract(state, r"^[^\[]*", 0), ":") > 0, state).otherwise(F.concat(F.lit(f"{DEFAULT_NAMESPACE}:"), state))
    name, inner = F.regexp_extract(full, r"^[^\[]*", 0), F.regexp_extract(full, r"\[([^\]]*)\]$", 1)
    sound = full.rlike(r"^[a-z0-9_.-]+:[a-z0-9_./-]+(\[[a-z0-9_]+=[a-z0-9_.-]+(,[a-z0-9_]+=[a-z0-9_.-]+)*\])?$")
    return F.when(sound, F.concat(name, F.when(inner == "", "").otherwise(F.concat(F.lit("["), F.array_join(F.array_sort(F.split(inner, ",")), ","), F.lit("]")))))


def base_material(state: Column) -> Column:
    return F.regexp_replace(F.split_part(state, F.lit("["), F.lit(1)), f"^{DEFAULT_NAMESPACE}:", "")


def stable_id(prefix: str, *parts: Column, digits: int = 24) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", F.lit(prefix), *[p.cast("string") for p in parts]), 256), 1, digits)


def asset_id(sample: Column, revision: Column) -> Column:
    return F.concat(sample.cast("string"), F.lit("-r"), F.lpad(revision.cast("string"), 4, "0"))


def price_micros(tokens_in: Column, tokens_out: Column, in_price: int, out_price: int) -> Column:
    """Price in millionths, null unless both counts are known and not negative."""
    return F.when((tokens_in >= 0) & (tokens_out >= 0), tokens_in * in_price + tokens_out * out_price)


def retry_delay(value: Column, now: Column | None = None) -> Column:
    """Seconds from a header that holds a finite number or an HTTP date, within 0..3600; 5 where it is neither."""
    number = value.try_cast("double")
    date = F.regexp_extract(value, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1)
    when = F.try_to_timestamp(F.concat(F.nullif(date, F.lit("")), F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z"))
    left = when.cast("double") - (F.current_timestamp() if now is None else now).cast("double")
    seconds = F.when(number.isNull(), left).when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return F.when(seconds.isNull(), 5.0).otherwise(F.least(F.lit(3600.0), F.greatest(F.lit(0.0), seconds)))  # least and greatest skip nulls


def error_category(status: Column) -> Column:
    """The category of a response by its status; null below 300."""
    return (
        F.when(status == 429, "rate_limited").when(status.isin(401, 403), "endpoint_auth").when(status == 402, "endpoint_quota")
        .when(status.between(300, 399) | status.isin(400, 404, 422), "endpoint_configuration").when(status >= 500, "service_busy").when(status >= 300, "provider_error")
    )


def mode_rank(mode: Column) -> Column:
    rank = F.lit(None).cast("int")
    for i, m in enumerate(MODES):
        rank = F.when(mode == m, i).otherwise(rank)
    return rank


def within_allowance(mode: Column, observed: Column, focus: Column, extraneous: Column) -> Column:
    """Whether an observation stays within its mode's allowance; null where it is unclear."""
    return (
        F.when((focus == "unclear") | observed.isNull(), F.lit(None).cast("boolean"))
        .when(focus.isin("absent", "incidental") | extraneous, False)
        .otherwise((mode_rank(observed) <= mode_rank(mode)) & (~mode.isin(*LIMITED) | (focus == "dominant")))
    )


def complies(mode: Column, observed: Column, focus: Column, extraneous: Column) -> Column:
    """Within the allowance and of the very class asked for; null where it is unclear."""
    allowed = within_allowance(mode, observed, focus, extraneous)
    return F.when(allowed.isNotNull(), allowed & (observed == mode))


def minute(seconds: Column) -> Column:
    return (F.floor(seconds / 60) * 60).cast("long")


def progress(done: Column, target: Column) -> Column:
    """Per cent, at most 100; 0 without a target."""
    return F.when(target > 0, F.least(F.lit(100.0), done / target * 100)).otherwise(0.0)


def version_record(version: Column, digest: Column) -> Column:
    return F.when(digest.rlike("^[0-9a-f]{64}$") & version.rlike(r"^[A-Za-z0-9._-]+$"), F.concat(version, F.lit("@sha256:"), digest))


def capacity_key(pool: Column, url: Column) -> Column:
    return F.sha2(F.coalesce(pool, F.rtrim(url, F.lit("/"))), 256)


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


#: Execution states.
STATES = ("not_sent", "execution_unknown", "terminated")


def execution_state(given: Column, category: Column, complete: Column) -> Column:
    """The stated execution state where it is one, else the one that completion and error category imply."""
    return F.when(given.isin(*STATES), given).when(complete, "terminated").when(category.isin("request", "auth", "rate_limit"), "not_sent").otherwise("execution_unknown")


def instruction(parts: list[Column], fallback: Column) -> Column:
    """The non-empty parts joined by an ideographic full stop, or the fallback."""
    joined = F.array_join(F.filter(F.array(*parts), lambda p: F.coalesce(F.trim(p), F.lit("")) != ""), "。")
    return F.when(joined != "", joined).otherwise(fallback)


def legal_mode(scene: Column, mode: Column) -> Column:
    """Whether a composition mode is allowed for the scene: none for natural ones, the last two for hybrid ones."""
    return mode.isNull() | (mode.isin(*MODES) & (scene != "natural") & ((scene != "hybrid") | mode.isin(*MODES[2:])))


def qualified(reviewed: Column, passed: Column, hash_: Column, expected: Column, least: int = 100, share: float = 0.96) -> Column:
    return F.coalesce((reviewed >= least) & (passed / reviewed >= share) & (hash_ == expected), F.lit(False))


def rebased(path: Column, old: str, new: str) -> Column:
    """The path below the new root, if it lies below the old one."""
    old, new = old.rstrip("/"), new.rstrip("/")
    return F.when(path == old, new).when(path.startswith(old + "/"), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.char_length(path)))).otherwise(path)


def review_verdict(body: Column) -> Column:
    """verdict, n_issues and fault of a review's JSON; a pass with issues is gray, a malformed review has a fault."""
    r = F.from_json(body, "verdict string, issues array<string>")
    n = F.coalesce(F.size(F.filter(r["issues"], lambda i: F.trim(i) != "")), F.lit(0))
    fault = F.when(r["verdict"].isNull() | ~r["verdict"].isin("pass", "gray", "fail"), "verdict").when((r["verdict"] == "fail") & (n == 0), "fail_without_issue")
    return F.struct(F.when(fault.isNull(), F.when((r["verdict"] == "pass") & (n > 0), "gray").otherwise(r["verdict"])).alias("verdict"), n.alias("n_issues"), fault.alias("fault"))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID: sha1 of the namespace's bytes and the name, with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def fenced_source(content: Column) -> Column:
    """The body of the one complete code fence that starts the text; null if there is none, or more than one."""
    fence = r"^\s*```[A-Za-z0-9_+-]*\n([\s\S]*?)\n```\s*$"
    body = F.regexp_extract(content, fence, 1)
    return F.when(content.rlike(fence) & ~F.contains(body, F.lit("```")), body)


def tags_as_pairs(tags: Column) -> Column:
    """Tags ``key:value`` or ``key`` as structs; a tag without a value has none."""
    return F.transform(tags, lambda t: F.struct(F.split_part(t, F.lit(":"), F.lit(1)).alias("key"), F.when(F.instr(t, ":") > 0, F.substring(t, F.instr(t, ":") + F.lit(1), F.char_length(t))).alias("value")))


def redacted(values: Column, secret: str = "(?i)(key|token|secret|password|credential)") -> Column:
    """A map with the values under telling keys hidden."""
    return F.transform_values(values, lambda k, v: F.when(k.rlike(secret) & v.isNotNull(), F.lit("***")).otherwise(v))


def limits_text(mode: Column) -> Column:
    """The measured limits of a mode as a sentence; null for modes without any."""
    return F.when(mode == LIMITED[0], F.lit("context at most 10%, subject columns at least 80%")).when(mode == LIMITED[1], F.lit("context at most 25%, subject columns at least 60%"))


def source_policy(source: Column, banned: tuple[str, ...] = ("eval", "exec", "open", "compile", "__import__", "globals", "getattr")) -> Column:
    """(ok, reason) of Python source by its syntax tree; it is parsed, never run. A null source is refused."""

    @F.pandas_udf("ok boolean, reason string")
    def judge(sources):  # noqa: ANN001, ANN202
        import ast

        import pandas as pd

        def reason(text: str | None) -> str | None:
            if text is None:
                return "missing"
            try:
                tree = ast.parse(text)
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                return "syntax"
            for node in ast.walk(tree):
                if isinstance(node, (ast.Import, ast.ImportFrom)):
                    return "import"
                if isinstance(node, ast.Attribute) and node.attr.startswith("__"):
                    return "reflection"
                if isinstance(node, ast.Name) and node.id in banned:
                    return f"banned:{node.id}"
            return None

        why = [reason(s) for s in sources]
        return pd.DataFrame({"ok": [w is None for w in why], "reason": why})

    return judge(source)
