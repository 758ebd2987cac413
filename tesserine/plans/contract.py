"""The study contract: endpoints, cohorts and studies as frozen objects that are checked when they are built."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column

from tesserine.functions import labels as L

OBJECTIVES = ("binary", "multiclass", "regression", "regression_vector", "survival")
RESERVED = ("patient_id", "image_path", "mask_path", "reader", "staining")
STRATEGY_OF_ROLE = {"development": "nested_cv", "validation": "all_test", "predict": "all_predict"}
CATEGORIES = ("fit", "validate", "test", "predict")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class Binning:
    """Strata of a number: at the median, at k quantiles, or at given edges."""

    kind: str = "median"
    k: int | None = None
    edges: tuple[float, ...] = ()

    def __post_init__(self):
        _require(self.kind in ("median", "quantile", "threshold"), f"unknown binning {self.kind!r}")
        _require((self.kind == "quantile") == (self.k is not None), "k goes with quantile binning")
        _require(self.k is None or self.k >= 2, "quantile binning needs k >= 2")
        _require((self.kind == "threshold") == bool(self.edges), "edges go with threshold binning")
        _require(list(self.edges) == sorted(set(self.edges)), "edges must ascend")

    def probabilities(self) -> list[float]:
        """Where the cuts lie among the values; none for given edges."""
        if self.kind == "median":
            return [0.5]
        return [j / self.k for j in range(1, self.k)] if self.k else []


@dataclass(frozen=True)
class Binarize(Binning):
    """Two classes: at the median, or at one value with kind threshold."""

    def __post_init__(self):
        super().__post_init__()
        _require(self.kind != "threshold" or len(self.edges) == 1, "binarize takes one value")


@dataclass(frozen=True)
class Discretize(Binning):
    """Three or more classes."""

    kind: str = "quantile"

    def __post_init__(self):
        super().__post_init__()
        _require(self.kind != "median", "the median gives two classes: use binarize")
        _require(self.k is None or self.k >= 3, "discretize needs k >= 3")
        _require(self.kind != "threshold" or len(self.edges) >= 2, "discretize needs two edges or more")

    @property
    def classes(self) -> int:
        return self.k or len(self.edges) + 1


@dataclass(frozen=True)
class Endpoint:
    """A prediction target: where its values come from, what is predicted, and how patients are stratified.

    Exactly one of mapping, binarize, discretize and numeric says how a raw value becomes a target.
    """

    name: str
    objective: str
    column: str | None = None
    mapping: Mapping[str, int] | None = None
    binarize: Binarize | None = None
    discretize: Discretize | None = None
    numeric: str | None = None  # "identity" or "log1p"
    time_column: str | None = None
    event_column: str | None = None
    panel: str | None = None
    stratify: str | Binning | None = None  # a column, a binning, or the target itself

    def __post_init__(self):
        _require(self.objective in OBJECTIVES, f"unknown objective {self.objective!r}")
        _require(self.name not in RESERVED and (self.column or "") not in RESERVED, f"{self.name}: a reserved name")
        given = [x for x in (self.mapping, self.binarize, self.discretize, self.numeric) if x is not None]
        if self.objective == "survival":
            _require(bool(self.time_column and self.event_column) and not given, f"{self.name}: survival takes a time and an event column and no transform")
        elif self.objective == "regression_vector":
            _require(not given and self.stratify is None, f"{self.name}: a vector takes no transform and no strata")
        else:
            _require(len(given) == 1, f"{self.name}: exactly one transform is needed")
            if self.objective == "regression":
                _require(self.numeric in ("identity", "log1p"), f"{self.name}: regression takes a numeric transform")
                if self.stratify is None:
                    object.__setattr__(self, "stratify", Binning("median"))
            elif self.objective == "binary":
                _require(self.binarize is not None or self.mapping is not None and set(self.mapping.values()) == {0, 1}, f"{self.name}: binary needs two classes")
            else:
                n = self.discretize.classes if self.discretize else len(set((self.mapping or {}).values()))
                _require(self.binarize is None and self.numeric is None and n >= 3, f"{self.name}: multiclass needs three classes or more")

    @property
    def source(self) -> str:
        return self.column or self.name

    @property
    def classes(self) -> int | None:
        if self.objective == "binary":
            return 2
        if self.objective == "multiclass":
            return self.discretize.classes if self.discretize else len(set(self.mapping.values()))
        return None

    def head_width(self, n_bins: int | None = None, n_genes: int | None = None) -> int:
        """Outputs of a model of this endpoint."""
        return {"binary": 1, "multiclass": self.classes, "regression": 1, "survival": n_bins, "regression_vector": n_genes}[self.objective]

    def target(self, resolved: Mapping[str, object] | None = None) -> Column:
        """The target of a raw string column; quantile cuts come resolved as {"edges": [...]}."""
        raw = L.col(self.source)
        if self.mapping is not None:
            return L.categorical(raw, self.mapping)
        x = L.number(raw)
        spec = self.binarize or self.discretize
        if spec is not None:
            edges = list(spec.edges or (resolved or {})["edges"])
            return L.binarize(x, edges[0]) if self.binarize else L.discretize(x, edges)
        return L.log1p(x) if self.numeric == "log1p" else x


def endpoint(name: str, type: str, **options) -> Endpoint:
    """The short form {type: binary | multiclass | continuous | expression | survival} (1.3)."""
    objective = {"continuous": "regression", "expression": "regression_vector"}.get(type, type)
    if objective == "regression":
        options.setdefault("numeric", "identity")
    if "values" in options:
        options["mapping"] = {v: k for k, v in enumerate(options.pop("values"))}
    return Endpoint(name, objective, **options)


@dataclass(frozen=True)
class Cohort:
    """A data source: its role in studies comes from the study."""

    name: str
    fields: Mapping[str, Endpoint]
    reader: str = "OPENSLIDE"
    staining: str = "HE"
    modalities: tuple[str, ...] = ()

    def __post_init__(self):
        for key, f in self.fields.items():
            _require(key == f.name, f"{key}: the endpoint is named {f.name}")

    def columns(self) -> set[str]:
        """The sheet columns that the contract needs."""
        out: set[str] = set()
        for f in self.fields.values():
            out |= {f.time_column, f.event_column} if f.objective == "survival" else set() if f.objective == "regression_vector" else {f.source}
            if isinstance(f.stratify, str):
                out.add(f.stratify)
        return out


@dataclass(frozen=True)
class Study:
    """Cohorts by role, split parameters, targets and censoring horizons."""

    name: str
    roles: Mapping[str, str]  # cohort -> role
    targets: tuple[str, ...]
    n_outer: int = 5
    n_inner: int = 5
    seed: int = 42
    horizons: Mapping[str, float] = field(default_factory=dict)

    def __post_init__(self):
        _require(self.n_outer >= 2 and self.n_inner >= 1, "nested CV needs n_outer >= 2 and n_inner >= 1")
        _require(bool(self.targets), "a study needs targets")
        _require(set(self.roles.values()) <= set(STRATEGY_OF_ROLE), "unknown role")
        _require("development" in self.roles.values(), "a study needs a development cohort")
        _require(all(v > 0 for v in self.horizons.values()), "horizons must be positive")
        _require(set(self.horizons) <= set(self.targets), "horizons must be on the study's targets")

    def strategy(self, cohort: str) -> str:
        return STRATEGY_OF_ROLE[self.roles[cohort]]

    def contract(self, cohort: Cohort) -> Cohort:
        """The cohort with the endpoints that this study targets."""
        missing = [t for t in self.targets if t not in cohort.fields]
        _require(not missing, f"{cohort.name} has no {', '.join(missing)}")
        return replace(cohort, fields={t: cohort.fields[t] for t in self.targets})


def class_weights(spec: str | Mapping[int, float] | None, classes: int) -> str | dict[int, float] | None:
    """A checked class-weight spec: none, "balanced", or a positive weight a class."""
    if spec is None or spec == "balanced":
        return spec
    _require(isinstance(spec, Mapping) and set(spec) == set(range(classes)) and all(v > 0 for v in spec.values()), "weights must be positive, one a class")
    return dict(spec)
