"""Per-source parameters and the table schemas shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names of the pipeline steps as they stand in the control log's `origem`.
# The unpack step carries the source's name: `unzip_<source>`.
COPY_STAGE = "ingerir_cumulative"
RULES_STAGE = "glue_data_quality"
JOB_STAGE = "glue_job"
VOLUME_STAGE = "quality_check"
CHECK_STAGE = "checar_pipeline"
DISPATCH_STAGE = "trigger_bronze"

# States of an orchestrated job run.
FAILURE_STATES = ("FAILED", "TIMEOUT", "ERROR")
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "TIMEOUT", "ERROR", "STOPPED")

# Meaning of each action code of the feed.
ACTIONS = {
    "NEWT": "new transaction",
    "MODI": "modification",
    "CORR": "correction",
    "TERM": "termination",
    "EROR": "annulment",
    "REVI": "revision",
}

PROVENANCE = ("arquivo_origem", "line_number", "ingerido_em")


# The feed's own column names.
@dataclass(frozen=True)
class EventColumns:
    """Names of the raw columns the typed layers read."""

    diss_id: str = "Dissemination Identifier"
    orig_id: str = "Original Dissemination Identifier"
    action: str = "Action type"
    event: str = "Event type"
    event_ts: str = "Event timestamp"
    asset_class: str = "Asset Class"
    product: str = "Product name"
    notional: str = "Notional amount-Leg 1"
    currency: str = "Notional currency-Leg 1"

    def raw_names(self) -> dict[str, str]:
        """Short name of each declared column -> its name in the file."""
        return dict(self.__dict__)


# The defaults are the feed's and its log's own names and limits.
@dataclass(frozen=True)
class Contract:
    """Everything that tells one source from another. A second source is a second instance."""

    name: str
    columns: EventColumns = field(default_factory=EventColumns)

    # Where files come from.
    source_template: str = "{fonte}/eod/{fonte_upper}_CUMULATIVE_{classe_ativo}_{data_underscore}.zip"
    default_class: str = "RATES"
    default_regulator: str = "cftc"

    # Data quality rules.
    required_columns: tuple[str, ...] = (
        "Dissemination Identifier",
        "Original Dissemination Identifier",
        "Action type",
        "Event timestamp",
    )
    id_column: str = "Dissemination Identifier"
    uniqueness_floor: float = 0.99
    domain_column: str = "Action type"
    domain_values: tuple[str, ...] = tuple(ACTIONS)

    # Volume check.
    history_days: int = 7
    max_drop: float = 0.5
    seasonal: bool = True
    seasonal_weeks: int = 4

    # Pipeline checks. Empty stages are filled in from the source's name.
    lineage_window_days: int = 3
    lineage_margin_hours: int = 2
    start_stage: str = ""
    expected_stages: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        start = self.start_stage or f"unzip_{self.name}"
        object.__setattr__(self, "start_stage", start)
        if not self.expected_stages:
            object.__setattr__(self, "expected_stages", (start, RULES_STAGE, JOB_STAGE, VOLUME_STAGE))

    @property
    def zip_prefix(self) -> str:
        return f"raw/{self.name}_zip/"

    @property
    def raw_prefix(self) -> str:
        return f"raw/{self.name}/"


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


# The part of a day of the control log that one batch writes, and writes again when it is replayed.
LEAF = "lote"

# Control log: one record per pipeline step. `dt` stays a string so that it is never inferred as a date.
CONTROL = _fields(
    ("timestamp", T.StringType()),
    ("origem", T.StringType()),
    ("csv", T.StringType()),
    ("zip", T.StringType()),
    ("job_run_id", T.StringType()),
    ("execution_id", T.StringType()),
    ("linhas", T.LongType()),
    ("problemas", T.ArrayType(T.StringType())),
    ("status", T.StringType()),
    ("duracao_segundos", T.LongType()),
    ("regra", T.StringType()),
    ("outcome", T.StringType()),
    ("motivo_falha", T.StringType()),
    ("metrica_nome", T.StringType()),
    ("metrica_valor", T.DoubleType()),
    ("dt", T.StringType()),
)

RUNS = _fields(("name", T.StringType()), ("start_date", T.TimestampType()), ("status", T.StringType()))

JOB_EVENTS = _fields(
    ("job_name", T.StringType()),
    ("job_run_id", T.StringType()),
    ("state", T.StringType()),
    ("event_time", T.TimestampType()),
)

JOB_RUNS = _fields(
    ("job_name", T.StringType()),
    ("job_run_id", T.StringType()),
    ("arguments", T.MapType(T.StringType(), T.StringType())),
    ("execution_time", T.LongType()),
)
