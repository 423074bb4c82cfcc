"""One spec for both configuration dialects: grouped sources, and a flat list of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from millrace.plans.load import MODES

_SHARED = {
    "name", "type", "table", "target_table", "mode", "load_mode", "params", "incremental", "export_parquet",
    "post", "key_columns", "since_field", "since_value", "every_minutes", "order_by", "dedupe_batch", "dq_scope", "time_limit_seconds",
}


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    """One name or a list of names."""
    return (value,) if isinstance(value, str) else tuple(value or ())


@dataclass(frozen=True)
class SourceSpec:
    name: str
    type: str
    table: str
    mode: str = "replace"
    params: Mapping = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    cast_map: Mapping[str, str] = field(default_factory=dict)
    order_by: tuple[str, ...] = ()
    dedupe_batch: bool = False
    export: Mapping = field(default_factory=dict)
    post: Mapping = field(default_factory=dict)
    since_field: str | None = None
    since_value: str | None = None
    every_minutes: int | None = None
    dq_scope: str = "table"  # table | batch
    time_limit_seconds: float | None = None

    @classmethod
    def from_dict(cls, d: Mapping, defaults: Mapping | None = None) -> "SourceSpec":
        table = d.get("table") or d.get("target_table") or d.get("name")
        if not table:
            raise ValueError("a source needs a name or a table")
        if not d.get("type"):
            raise ValueError(f"source {table} has no type")
        mode = d.get("mode") or d.get("load_mode") or (defaults or {}).get("mode") or "replace"
        if mode not in MODES:
            raise ValueError(f"unknown load mode {mode!r}; use one of {MODES}")
        step = d.get("incremental") or {}
        keys = step.get("key") or d.get("key_columns")
        # The flat dialect writes the source's own options beside the shared ones.
        params = {**{k: v for k, v in d.items() if k not in _SHARED}, **(d.get("params") or {})}
        if d["type"] == "api" and "path" not in params:
            raise ValueError(f"source {table}: params.path must name the landed pages")
        return cls(
            name=d.get("name") or table,
            type=d["type"],
            table=table,
            mode=mode,
            params=params,
            keys=_names(keys),
            cast_map=step.get("cast_map") or {},
            order_by=_names(d.get("order_by") or step.get("order_by")),
            dedupe_batch=bool(d.get("dedupe_batch") or step.get("dedupe_batch")),
            export=d.get("export_parquet") or {},
            post=d.get("post") or params.get("post") or {},
            since_field=d.get("since_field"),
            since_value=d.get("since_value"),
            every_minutes=d.get("every_minutes"),
            dq_scope=d.get("dq_scope", "table"),
            time_limit_seconds=d.get("time_limit_seconds"),
        )


def group_sources(config: Mapping, group: str) -> list[SourceSpec]:
    """The sources of one group; an unknown group is empty."""
    defaults = config.get("defaults") or {}
    return [SourceSpec.from_dict(s, defaults) for s in (config.get("groups") or {}).get(group) or []]


def load_yaml(path: str) -> dict:
    """A YAML file as a dict; an empty file is an empty dict."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("reading YAML specs needs PyYAML; pass a dict instead") from e
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
