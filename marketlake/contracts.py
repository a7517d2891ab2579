"""Declarative table contracts.

A contract is the single description of a published table: column order, Spark
types, nullability, byte-length bounds, allowed values, row rules, unique keys
and the primary key.  Contracts are plain data: nothing here touches Spark until
``struct_type`` is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
}


@dataclass(frozen=True)
class Col:
    """One column of a contract; lengths count UTF-8 bytes."""

    name: str
    kind: str
    nullable: bool = True
    min_length: int | None = None
    max_length: int | None = None
    values: tuple = ()

    @property
    def data_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class RowRule:
    """A named per-row predicate in SQL; a NULL result counts as a pass."""

    name: str
    predicate: str


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...]
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    row_rules: tuple[RowRule, ...] = ()
    # Columns that may be absent from the whole source; they are added as NULL.
    optional: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Col:
        return next(c for c in self.columns if c.name == name)

    def struct_type(self) -> T.StructType:
        """The table's Spark schema.

        Strings stay STRING rather than VARCHAR(n): an over-long value must reach
        quarantine as a rule failure instead of failing the whole write.
        """
        return T.StructType([T.StructField(c.name, c.data_type, c.nullable) for c in self.columns])

    def widen(self, *names: str) -> Contract:
        """Keep fractions in the named integer columns by declaring them double."""
        unknown = set(names) - set(self.names)
        if unknown:
            raise ValueError(f"{self.name} has no columns {sorted(unknown)}")
        columns = tuple(
            Col(c.name, "double", c.nullable) if c.name in names else c for c in self.columns
        )
        return Contract(
            self.name, columns, self.primary_key, self.unique, self.row_rules, self.optional
        )


def _columns(text: str) -> tuple[Col, ...]:
    """Read ``name type [min..max] [required]`` lines.

    A string without bounds is 0..255 bytes when nullable and 1..255 when required.
    """
    out = []
    for line in text.strip().splitlines():
        name, kind, *flags = line.split()
        required = "required" in flags
        low, high = (int(required), 255) if kind == "string" else (None, None)
        for flag in flags:
            if ".." in flag:
                low, high = (int(x) for x in flag.split(".."))
        out.append(Col(name, kind, not required, low, high))
    return tuple(out)


# ---------------------------------------------------------------------------
# Column names, order, types, bounds and keys of the published
# tables, and the allowed relation types.
# ---------------------------------------------------------------------------

RELATION_TYPES = (
    "complement",
    "equivalent",
    "implies",
    "mutex",
    "composite",
    "disjunction",
    "upper_bound",
    "lower_bound",
    "conditional",
)

MARKETS = Contract(
    name="bronze_gamma_markets",
    primary_key=("market_id",),
    unique={"unique_market_slug": ("market_slug",), "unique_market_id": ("market_id",)},
    row_rules=(
        # NULL text passes; malformed text fails instead of stopping the job.
        RowRule(
            "clob_token_ids_format",
            "clob_token_ids IS NULL OR coalesce(json_array_length(clob_token_ids) = 2, false)",
        ),
        RowRule("outcomes_json", "outcomes IS NULL OR json_array_length(outcomes) IS NOT NULL"),
    ),
    columns=_columns("""
        market_id                        string  required
        market_slug                      string  required
        event_id                         string  required
        event_slug                       string  required
        question                         string  required
        condition_id                     string  66..66 required
        resolution_source                string
        end_date                         string
        liquidity                        string
        start_date                       string
        image                            string  0..500
        icon                             string  0..500
        description                      string  0..50000
        outcomes                         string
        outcome_prices                   string
        active                           boolean required
        closed                           boolean required
        archived                         boolean required
        closed_time                      string
        market_maker_address             string
        created_at                       string
        updated_at                       string
        is_new                           boolean
        featured                         boolean
        submitted_by                     string
        resolved_by                      string
        restricted                       boolean
        group_item_title                 string
        question_id                      string
        enable_order_book                boolean
        order_price_min_tick_size        double
        order_min_size                   bigint
        liquidity_num                    double
        end_date_iso                     string
        start_date_iso                   string
        has_reviewed_dates               boolean
        game_start_time                  string
        seconds_delay                    bigint
        clob_token_ids                   string
        uma_bond                         string
        uma_reward                       string
        liquidity_clob                   double
        custom_liveness                  bigint
        accepting_orders                 boolean
        neg_risk                         boolean
        neg_risk_request_id              string
        ready                            boolean
        funded                           boolean
        accepting_orders_timestamp       string
        cyom                             boolean
        competitive                      double
        pager_duty_notification_enabled  boolean
        approved                         boolean
        rewards_min_size                 bigint
        rewards_max_spread               double
        spread                           double
        best_bid                         double
        best_ask                         double
        automatically_active             boolean
        automatically_resolved           boolean
        clear_book_on_start              boolean
        manual_activation                boolean
        neg_risk_other                   boolean
        game_id                          string
        sports_market_type               string
        uma_resolution_status            string
        uma_resolution_statuses          string
        uma_end_date                     string
        pending_deployment               boolean
        deploying                        boolean
        deploying_timestamp              string
        rfq_enabled                      boolean
        event_start_time                 string
        holding_rewards_enabled          boolean
        fees_enabled                     boolean
        requires_translation             boolean
        fee_type                         string
        line                             double
        group_item_threshold             string
        group_item_range                 string
        maker_base_fee                   bigint
        taker_base_fee                   bigint
        show_gmp_series                  boolean
        show_gmp_outcome                 boolean
        maker_rebates_fee_share_bps      bigint
        volume                           string
        volume_num                       double
        volume_clob                      double
        last_trade_price                 double
        volume_24_hr                     bigint
        volume_1_wk                      bigint
        volume_1_mo                      bigint
        volume_1_yr                      bigint
        volume_24_hr_amm                 bigint
        volume_1_wk_amm                  bigint
        volume_1_mo_amm                  bigint
        volume_1_yr_amm                  bigint
        volume_24_hr_clob                bigint
        volume_1_wk_clob                 bigint
        volume_1_mo_clob                 bigint
        volume_1_yr_clob                 bigint
        volume_amm                       bigint
        liquidity_amm                    bigint
        one_day_price_change             bigint
        one_hour_price_change            bigint
        one_week_price_change            bigint
        one_month_price_change           bigint
        one_year_price_change            bigint
        neg_risk_market_id               string
        series_color                     string
    """),
)

EVENTS = Contract(
    name="bronze_gamma_events",
    primary_key=("event_id",),
    unique={"unique_event_slug": ("event_slug",), "unique_event_id": ("event_id",)},
    optional=("liquidity_amm",),
    columns=_columns("""
        event_id              string  required
        event_slug            string  required
        ticker                string  required
        title                 string  required
        description           string  0..50000
        resolution_source     string
        start_date            string
        creation_date         string
        end_date              string
        image                 string  0..500
        icon                  string  0..500
        active                boolean required
        closed                boolean required
        archived              boolean required
        is_new                boolean
        featured              boolean
        restricted            boolean
        liquidity             double
        volume                double
        open_interest         bigint
        created_at            string
        updated_at            string
        competitive           double
        volume_24_hr          double
        volume_1_wk           double
        volume_1_mo           double
        volume_1_yr           double
        enable_order_book     boolean
        liquidity_clob        double
        neg_risk              boolean
        comment_count         bigint
        cyom                  boolean
        show_all_outcomes     boolean
        show_market_images    boolean
        enable_neg_risk       boolean
        automatically_active  boolean
        gmp_chart_mode        string
        neg_risk_augmented    boolean
        cumulative_markets    boolean
        pending_deployment    boolean
        deploying             boolean
        requires_translation  boolean
        neg_risk_market_id    string
        series_slug           string
        estimate_value        boolean
        sort_by               string
        deploying_timestamp   string
        event_date            string
        start_time            string
        color                 string
        created_by            string
        country_name          string
        election_type         string
        featured_order        bigint
        event_week            bigint
        score                 string
        elapsed               string
        period                string
        live                  boolean
        ended                 boolean
        game_id               bigint
        finished_timestamp    string
        cant_estimate         boolean
        parent_event_id       bigint
        estimated_value       string
        tweet_count           bigint
        liquidity_amm         bigint
    """),
)

SERIES = Contract(
    name="bronze_gamma_series",
    primary_key=("series_id",),
    unique={"unique_series_slug": ("series_slug",), "unique_series_id": ("series_id",)},
    optional=("description",),
    columns=_columns("""
        series_id             string  required
        series_slug           string  required
        ticker                string  required
        title                 string  required
        series_type           string  1..255
        recurrence            string
        description           string  0..50000
        subtitle              string  1..255
        image                 string  0..500
        icon                  string  0..500
        active                boolean required
        closed                boolean required
        archived              boolean required
        is_new                boolean
        featured              boolean
        restricted            boolean
        comments_enabled      boolean
        competitive           double
        start_date            string
        created_by            string
        updated_by            string
        created_at            string
        updated_at            string
        published_at          string
        volume_24_hr          bigint
        liquidity             double
        volume                double
        comment_count         int     required
        requires_translation  boolean required
    """),
)

EVENT_SERIES_LINK = Contract(
    name="bronze_gamma_event_series_link",
    primary_key=("series_id", "event_id"),
    unique={
        "unique_event_slug_series_slug": ("event_slug", "series_slug"),
        "unique_event_id_series_id": ("event_id", "series_id"),
    },
    columns=_columns("""
        series_id    string required
        event_id     string required
        series_slug  string required
        event_slug   string required
    """),
)

TAGS = Contract(
    name="bronze_gamma_tags",
    primary_key=("tag_id",),
    unique={"unique_tag_slug": ("tag_slug",), "unique_tag_id": ("tag_id",)},
    columns=_columns("""
        tag_id                string  required
        tag_slug              string  required
        label                 string  1..255
        force_show            boolean
        force_hide            boolean
        is_carousel           boolean
        requires_translation  boolean required
        created_by            string
        updated_by            string
        created_at            string
        updated_at            string
        published_at          string
    """),
)

EVENT_TAG_LINK = Contract(
    name="bronze_gamma_event_tag_link",
    primary_key=("tag_id", "event_id"),
    unique={
        "unique_event_slug_tag_slug": ("event_slug", "tag_slug"),
        "unique_event_id_tag_id": ("event_id", "tag_id"),
    },
    columns=_columns("""
        tag_id      string required
        event_id    string required
        tag_slug    string required
        event_slug  string required
    """),
)

OUTCOMES = Contract(
    name="silver_market_outcomes",
    primary_key=("outcome_id",),
    # Names and slugs may repeat inside a market, so neither is a key.
    unique={
        "unique_outcome_id": ("outcome_id",),
        "unique_clob_token_id": ("clob_token_id",),
    },
    columns=(
        Col("outcome_id", "string", False, 1, 255),
        Col("outcome_slug", "string", False, 1, 355),
        Col("outcome_index", "smallint", False, values=(0, 1)),
        Col("market_id", "string", False, 1, 255),
        Col("market_slug", "string", False, 1, 255),
        Col("question", "string", False, 1, 255),
        Col("outcome_name", "string", False, 0, 100),
        Col("outcome_price", "double"),
        Col("clob_token_id", "string", False, 1, 255),
    ),
)

DEPENDENCIES = Contract(
    name="entry_outcome_dependencies",
    primary_key=("dependency_uuid",),
    # An ordered pair: (a, b) and (b, a) may both be present.
    unique={"unique_outcome_pair": ("outcome_id_a", "outcome_id_b")},
    row_rules=(
        RowRule("outcome_a_and_b_are_distinct", "outcome_id_a <> outcome_id_b"),
    ),
    columns=(
        Col("dependency_uuid", "string", False, 1, 255),
        Col("outcome_id_a", "string", False, 1, 255),
        Col("outcome_id_b", "string", False, 1, 255),
        Col("relationship_type", "string", False, values=RELATION_TYPES),
        Col("comments", "string", True, 0, 500),
    ),
)


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}.{self.parent_column}"


FOREIGN_KEYS = (
    ForeignKey("silver_market_outcomes", "market_id", "bronze_gamma_markets", "market_id"),
    ForeignKey("bronze_gamma_markets", "event_id", "bronze_gamma_events", "event_id"),
    ForeignKey("bronze_gamma_event_series_link", "event_id", "bronze_gamma_events", "event_id"),
    ForeignKey("bronze_gamma_event_series_link", "series_id", "bronze_gamma_series", "series_id"),
    ForeignKey("bronze_gamma_event_tag_link", "event_id", "bronze_gamma_events", "event_id"),
    ForeignKey("bronze_gamma_event_tag_link", "tag_id", "bronze_gamma_tags", "tag_id"),
    ForeignKey("entry_outcome_dependencies", "outcome_id_a", "silver_market_outcomes", "outcome_id"),
    ForeignKey("entry_outcome_dependencies", "outcome_id_b", "silver_market_outcomes", "outcome_id"),
)

CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        MARKETS,
        EVENTS,
        SERIES,
        TAGS,
        EVENT_SERIES_LINK,
        EVENT_TAG_LINK,
        OUTCOMES,
        DEPENDENCIES,
    )
}
