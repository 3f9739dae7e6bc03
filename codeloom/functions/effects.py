"""Column expressions for side-effect labels and model replies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Call names and name prefixes that prove a side effect.
DEFAULT_SIGNALS = {
    "memory": {
        "exact": [
            "malloc", "free", "realloc", "calloc",
            "heap_caps_malloc", "heap_caps_free", "heap_caps_calloc", "heap_caps_realloc",
            "pvPortMalloc", "vPortFree",
        ],
        "prefix": [],
    },
    "io": {
        "exact": [
            "printf", "fprintf", "fwrite", "fread", "write", "read",
            "fopen", "fclose", "puts", "fputs",
            "ESP_LOGI", "ESP_LOGE", "ESP_LOGW", "ESP_LOGD", "ESP_LOGV",
            "esp_log_write", "uart_write_bytes", "uart_read_bytes",
        ],
        "prefix": [],
    },
    "hardware": {
        "exact": [
            "gpio_set_level", "gpio_get_level", "gpio_config",
            "gpio_set_direction", "gpio_set_pull_mode",
            "uart_param_config", "uart_driver_install", "uart_driver_delete",
            "spi_bus_initialize", "spi_bus_free", "spi_device_transmit",
            "i2c_master_cmd_begin", "i2c_master_start", "i2c_master_stop",
            "REG_WRITE", "REG_READ", "WRITE_PERI_REG", "READ_PERI_REG",
            "SET_PERI_REG_MASK", "CLEAR_PERI_REG_MASK",
            "esp_rom_gpio_pad_select_gpio",
            "ledc_set_duty", "ledc_update_duty",
            "adc1_get_raw", "adc2_get_raw",
            "rmt_write_items", "rmt_rx_start", "rmt_tx_start",
            "timer_set_counter_value", "timer_start", "timer_pause",
            "esp_intr_alloc", "esp_intr_free", "esp_intr_enable", "esp_intr_disable",
        ],
        "prefix": [
            "HAL_", "gpio_", "uart_", "spi_", "i2c_", "ledc_", "adc_",
            "rmt_", "timer_", "esp_rom_gpio",
        ],
    },
}

# Labels a model may answer, label priority, record texts.
EFFECT_CHOICES = ["io", "memory", "hardware", "none"]
DOMINANCE_ORDER = ["hardware", "io", "memory", "none"]
ERROR_PURPOSE = "ERROR"
NO_PURPOSE = "Unable to generate description"

# The texts sent to the models.
EFFECTS_PROMPT_HEAD = (
    "You are an expert in embedded C. Analyze this function and identify "
    "its side effects. A side effect is an observable interaction beyond "
    "the return value:\n"
    "  - io: file/serial/log operations\n"
    "  - memory: heap allocation or deallocation\n"
    "  - hardware: GPIO, UART, SPI, register access, interrupts\n"
    "  - none: pure computation, no external interaction\n\n"
    "Function:\n"
)
EFFECTS_PROMPT_TAIL = (
    "\n\nRespond ONLY with valid JSON, no other text:\n"
    '{"side_effects": ["io"|"memory"|"hardware"|"none"]}'
)
PURPOSE_PROMPT_HEAD = "You are analyzing embedded C code. Given this function:\n<code>\n"
PURPOSE_PROMPT_TAIL = (
    "\n</code>\n\n"
    "Think step by step:\n"
    "1. What is the primary responsibility of this function?\n"
    "2. What does it set up, compute, or control?\n"
    "3. Who would call this function and why?\n\n"
    "Write your reasoning."
)
PURPOSE_PROMPT_SECOND = (
    "Based on your reasoning, write ONE concise sentence describing what "
    "this function does. Start with a verb. No JSON, just the sentence."
)

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


# Blanks of any script, and the separators of ASCII.
_BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _strings(items: list[str]) -> Column:
    return F.array(*[F.lit(i) for i in items]).cast("array<string>")


def rule_effects(names: Column, signals: dict = DEFAULT_SIGNALS) -> Column:
    """Sorted distinct labels proved by call names; row-local, no shuffle.

    Meant for a dictionary of the size of the default; a large one belongs in a
    table (``operators.labelling.side_effects_from_table``).
    """
    present = F.coalesce(names, F.array().cast("array<string>"))
    found = []
    for label in sorted(signals):
        hit = F.lit(False)
        if signals[label]["exact"]:
            hit = hit | F.arrays_overlap(present, _strings(signals[label]["exact"]))
        if signals[label]["prefix"]:
            pattern = r"\A(?:" + "|".join(re.escape(p) for p in signals[label]["prefix"]) + ")"
            hit = hit | _any_like(present, pattern)
        found.append(F.when(F.coalesce(hit, F.lit(False)), F.lit(label)))
    return F.array_compact(F.array(*found))


def _any_like(names: Column, pattern: str) -> Column:
    return F.exists(names, lambda name: name.rlike(pattern))


def is_ambiguous(effects: Column, names: Column) -> Column:
    """No label found although there are calls; no calls at all is clear."""
    return (F.size(effects) == 0) & (F.coalesce(F.size(names), F.lit(0)) > 0)


def effects_source(ambiguous: Column, failed: Column | None = None) -> Column:
    source = F.when(ambiguous, F.lit("llm_fallback")).otherwise(F.lit("deterministic"))
    return source if failed is None else F.when(failed, F.lit("error")).otherwise(source)


def effects_or_none(effects: Column) -> Column:
    """The list itself, or ``["none"]`` when it is empty or missing."""
    return F.when(F.size(effects) > 0, effects).otherwise(_strings(["none"]))


def labels_struct(purpose: Column, control_flow: Column, effects: Column) -> Column:
    return F.struct(
        purpose.alias("high_level_purpose"),
        F.coalesce(control_flow, F.array().cast("array<string>")).alias("control_flow_elements"),
        effects_or_none(effects).alias("side_effects"),
    )


def effects_prompt(code: Column) -> Column:
    return F.concat(F.lit(EFFECTS_PROMPT_HEAD), code, F.lit(EFFECTS_PROMPT_TAIL))


def purpose_prompt(code: Column) -> Column:
    return F.concat(F.lit(PURPOSE_PROMPT_HEAD), code, F.lit(PURPOSE_PROMPT_TAIL))


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def first_messages(code: Column) -> Column:
    return F.array(_message("user", purpose_prompt(code))).cast(MESSAGES_TYPE)


def purpose_messages(code: Column, reply: Column) -> Column:
    """Second turn: first question, first answer, then the closing question."""
    return F.array(
        _message("user", purpose_prompt(code)),
        _message("assistant", reply),
        _message("user", F.lit(PURPOSE_PROMPT_SECOND)),
    ).cast(MESSAGES_TYPE)


def parse_effects_reply(raw: Column) -> Column:
    """Struct ``(effects, status)`` of a model reply.

    ``valid``: allowed labels in reply order, duplicates kept. ``default``: not
    JSON as a whole, no such key, or nothing allowed in it, which gives ``["none"]``.
    ``error``: a document that is no object, or a value that is no list of
    scalars; the row must become an error record.
    """
    bare = F.btrim(
        F.replace(F.replace(raw, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")), F.lit(_BLANKS)
    )
    return _once(
        _whole_document(bare),
        lambda document: _once(
            F.try_variant_get(document, "$[0].side_effects", "variant"),
            lambda value: _once(F.schema_of_variant(value), lambda kind: _parsed(raw, document, value, kind)),
        ),
    )


def _whole_document(text: Column) -> Column:
    """The JSON document that ``text`` is from its start to its end, or null; as the only entry of a list ``$[0]``.

    The parser stops behind the first document and passes over what follows. So the text is parsed as the first entry of
    a list that ends with a mark that the text does not hold: only a text that is one document leaves the mark in second place.
    """

    def listed(mark: Column) -> Column:
        both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
        return _once(both, lambda pair: F.when(F.try_variant_get(pair, "$[1]", "string") == mark, pair))

    mark = F.when(text.contains('"."'), F.md5(text.cast("binary"))).otherwise(F.lit("."))
    return _once(mark, listed)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parsed(raw: Column, document: Column, value: Column, kind: Column) -> Column:
    """Struct ``(effects, status)`` from the document of a reply, its side effects and their kind."""
    items = F.try_variant_get(value, "$", "array<variant>")
    keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    nested = F.exists(items, lambda item: F.schema_of_variant(item).rlike("^(OBJECT|ARRAY)"))
    texts = F.when(
        kind.startswith("ARRAY"),
        F.transform(items, lambda item: F.try_variant_get(item, "$", "string")),
    ).when(kind.startswith("OBJECT"), keys)

    def with_allowed(allowed: Column) -> Column:
        status = (
            F.when(raw.isNull(), F.lit(None).cast("string"))
            .when(document.isNull(), "default")
            .when(~F.schema_of_variant(F.try_variant_get(document, "$[0]", "variant")).startswith("OBJECT"), "error")
            .when(value.isNull() | (kind == "STRING"), "default")
            .when(~kind.rlike("^(OBJECT|ARRAY)"), "error")
            .when(kind.startswith("ARRAY") & nested, "error")
            .when(F.size(allowed) > 0, "valid")
            .otherwise("default")
        )
        return _once(status, lambda status: F.struct(
            F.when(status == "valid", allowed)
            .when(status.isNotNull(), _strings(["none"]))
            .alias("effects"),
            status.alias("status"),
        ))

    return _once(F.filter(texts, lambda t: t.isin(EFFECT_CHOICES)), with_allowed)


def dominant_label(labels: Column, order: list[str] = DOMINANCE_ORDER) -> Column:
    """Label of highest priority; labels outside the order come last, as listed."""
    chain = None
    for label in order:
        hit = F.array_contains(labels, label)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.try_element_at(labels, F.lit(1)))


def relevant(a: Column, b: Column) -> Column:
    """Any shared label."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))
