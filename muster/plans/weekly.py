"""The weekly pack: every published table from one set of inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster import labels
from muster.operators import maps, provider_facts, reconcile, registrations, roster, scorecards, trends
from muster.operators.joins import assert_unique
from muster.plans.staging import Staging
from muster.sinks import Deck, with_position, write_by_region, write_points, write_report
from muster.sources.inputs import Inputs

# Fixed value: registrations and new sign-ups count from this day.
DEFAULT_SINCE = date(2023, 12, 1)


class WeeklyPack:
    """Lazy tables of one report run; nothing is computed until a table is used.

    ``staging`` holds the tables that many others are built from, so that each is computed once and the raw
    lists are read once. Without it everything stays lazy, which suits single tables.
    """

    def __init__(
        self,
        inputs: Inputs,
        as_of: date,
        since: date = DEFAULT_SINCE,
        service: str = labels.CPCS_SERVICE,
        region_labels: Mapping[str, str] = labels.REGION_SHORT,
        staging: Staging | None = None,
    ):
        self.inputs, self.as_of, self.since, self.service = inputs, as_of, since, service
        self.region_labels = region_labels
        self._staging = staging

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return self._staging.keep(df, name) if self._staging else df

    # Registers -----------------------------------------------------------------------------------

    @cached_property
    def contractor(self) -> DataFrame:
        return roster.latest_contractor(self.inputs.ref_contractor)

    @cached_property
    def roster(self) -> DataFrame:
        i = self.inputs
        return self._keep(
            roster.roster_latest(i.pharm_list, i.hundred_hour, self.contractor, i.icb_short), "roster"
        )

    @cached_property
    def contraception(self) -> DataFrame:
        i = self.inputs
        return self._keep(
            registrations.contraception_opt_ins(
                i.contraception_opt, i.contraception_reg, i.contraception_dereg, self.since, self.as_of
            ),
            "contraception",
        )

    @cached_property
    def bp(self) -> DataFrame:
        return registrations.bp_registrations(self.inputs.bp_reg, self.roster)

    @cached_property
    def bp_figures(self) -> DataFrame:
        """Registration counts; repeated (provider, day) rows go before the roster is looked up."""
        days = self.inputs.bp_reg.select("fcode", "reg_date").distinct()
        return registrations.bp_metrics(registrations.bp_registrations(days, self.roster), self.since)

    @cached_property
    def signups(self) -> DataFrame:
        i = self.inputs
        return registrations.signup_valid(
            registrations.latest_registrations(i.service_registrations, self.service),
            registrations.latest_deregistrations(i.service_deregistrations, self.service),
            self.roster,
        )

    @cached_property
    def signup_facts(self) -> DataFrame:
        i = self.inputs
        return self._keep(
            registrations.signup_facts(
                registrations.latest_registrations(i.service_registrations, self.service),
                registrations.latest_deregistrations(i.service_deregistrations, self.service),
                self.roster,
            ),
            "signup_facts",
        )

    @cached_property
    def reconciled_rows(self) -> DataFrame:
        return reconcile.reconcile(self.inputs.pharm1st, self.signups, self.roster)

    @cached_property
    def reconcile_factors(self) -> DataFrame:
        return reconcile.reconcile_factors(self.inputs.pharm1st, self.signups, self.roster)

    @cached_property
    def reconcile_counts(self) -> DataFrame:
        return reconcile.reconcile_counts(self.inputs.pharm1st, self.signups, self.roster)

    @cached_property
    def evidence(self) -> DataFrame:
        return self._keep(
            reconcile.reconcile_evidence(self.inputs.pharm1st, self.signup_facts, self.roster), "evidence"
        )

    # Counts --------------------------------------------------------------------------------------

    @cached_property
    def icb_totals(self) -> DataFrame:
        return roster.icb_totals(self.roster, self.inputs.icb_short)

    @cached_property
    def reconcile_by_icb(self) -> DataFrame:
        return self._keep(reconcile.reconcile_by_icb(self.evidence, self.icb_totals), "reconcile_by_icb")

    @cached_property
    def pharmacy_list(self) -> DataFrame:
        return reconcile.reconcile_pharmacy_list(self.evidence)

    @cached_property
    def signup_count(self) -> DataFrame:
        return reconcile.signup_valid_count(self.signup_facts, self.evidence)

    def _facts_by(self, *by: str) -> DataFrame:
        i = self.inputs
        return scorecards.service_facts(i.pharm1st, self.contraception, i.bp_reg, self.roster, self.since, by)

    @cached_property
    def _staged_facts(self) -> DataFrame:
        return self._keep(self._facts_by("icb_code", "week"), "service_facts")

    def facts(self, *by: str) -> DataFrame:
        """Service facts at the wanted grain: from the staged finest grain, or straight from the lists."""
        return scorecards.refold(self._staged_facts, by) if self._staging else self._facts_by(*by)

    @cached_property
    def national(self) -> DataFrame:
        return scorecards.national_from_facts(self.facts())

    def icb_card_for(self, keep_all_areas: bool = False) -> DataFrame:
        return scorecards.icb_from_facts(
            self.facts("icb_code"), self.inputs.icb_short, self.contractor, keep_all_areas
        )

    @cached_property
    def icb_card(self) -> DataFrame:
        return self._keep(self.icb_card_for(), "icb_card")

    @cached_property
    def regional(self) -> DataFrame:
        return scorecards.regional_scorecard(self.icb_card, self.region_labels)

    def _list_rows(self) -> DataFrame:
        i = self.inputs
        gone = registrations.latest_deregistrations(i.service_deregistrations, self.service)
        signed = registrations.latest_registrations(i.service_registrations, self.service)
        return provider_facts.list_rows(i.pharm1st, self.contraception, i.bp_reg, self.roster, signed, gone, self.since)

    @cached_property
    def area_detail(self) -> DataFrame:
        """Scorecard and reconciliation of every area from one fold of all lists."""
        folded = provider_facts.fold(self._list_rows(), ["icb_code"])
        return self._keep(provider_facts.area_detail(folded, self.inputs.icb_short, self.contractor), "area_detail")

    def region_detail(self, region: str | None = None) -> DataFrame:
        return scorecards.shown_detail(self.area_detail, region)

    # Trends and text -----------------------------------------------------------------------------

    @cached_property
    def trend(self) -> DataFrame:
        return trends.trend_from_facts(self.facts("week"))

    def last_dates(self, na_rm: bool = False) -> DataFrame:
        return registrations.last_dates(self.inputs.pharm1st, self.contraception, na_rm)

    @cached_property
    def _provider_facts(self) -> DataFrame:
        return self._keep(provider_facts.fold(self._list_rows()), "provider_facts")

    def narrative(self, na_rm: bool = False) -> DataFrame:
        return provider_facts.headline(self._provider_facts, na_rm)

    # Maps ----------------------------------------------------------------------------------------

    def area_map(self, measure: str, na_rm: bool = False) -> DataFrame:
        """Area classes of a measure with the map's title."""
        table = self.reconcile_by_icb if measure == labels.SIGNUP_GAP else self.icb_card
        dated = self.contraception if measure == labels.CONTRACEPTION else self.inputs.pharm1st
        classed = maps.icb_choropleth(table, self.inputs.boundaries, measure)
        return classed.withColumn("title", maps.map_title(measure, maps.last_opt_in(dated, na_rm)))

    def _list_of(self, service: str) -> DataFrame:
        return self.inputs.pharm1st if service == labels.PHARM1ST else self.contraception

    def points(self, service: str) -> DataFrame:
        return maps.contractor_points(self._list_of(service), self.roster, self.inputs.postcodes, service)

    def point_title(self, service: str) -> Column:
        return maps.point_map_title(service, maps.last_opt_in(self._list_of(service)))

    def status(self, service: str) -> DataFrame:
        return maps.contractor_status(self.points(service), service)

    def map_layers(self) -> DataFrame:
        """Points of both services with longitude and latitude, ready for a web map."""
        layers = [
            self.status(s).withColumns({"service": F.lit(s), "title": self.point_title(s), "legend": maps.legend(s)})
            for s in (labels.PHARM1ST, labels.CONTRACEPTION)
        ]
        return maps.with_lon_lat(layers[0].unionByName(layers[1]))

    def drawn_layers(self, staging: Staging) -> DataFrame:
        """The layers with each point's drawing position."""
        return with_position(self.map_layers(), ["service", "layer"], maps.draw_order(), staging, "drawn")

    # Deck ----------------------------------------------------------------------------------------

    def deck(self) -> dict[str, Callable[[], DataFrame]]:
        """The tables behind the slides, each built on first use."""
        return {
            "trend": lambda: self.trend,
            "trend_range": lambda: trends.trend_range(self.trend, na_rm=True),
            "headline": lambda: self.narrative(na_rm=True),
            "regional_long": lambda: trends.regional_long(self.regional),
            **{f"map_{m}": lambda m=m: self.area_map(m, na_rm=True) for m in maps.MEASURES},
        }

    # Contraception-only pack ---------------------------------------------------------------------

    def contraception_pack(self) -> dict[str, DataFrame]:
        """The contraception columns of the trend, the regional and area tables, and the area map."""
        columns = ["total_contractors", "contraception_opted_in", "pct_contraception"]
        return {
            "trend": self.trend.where(F.col("service") == labels.SERIES_LABELS[labels.CONTRACEPTION]),
            "headline": self.national.select(
                "contraception_opted_in",
                "pct_contraception",
                maps.last_opt_in(self.contraception).alias("last_contraception"),
            ),
            "regional": self.regional.select("region", *columns),
            "icb": self.region_detail().select("region_name", "icb", *columns),
            "map": self.area_map(labels.CONTRACEPTION),
        }


def weekly_report(
    inputs: Inputs,
    out_dir: str,
    as_of: date,
    since: date = DEFAULT_SINCE,
    service: str = labels.CPCS_SERVICE,
    strict_keys: bool = False,
    resume: bool = False,
) -> dict[str, str]:
    """Write the four-sheet report, the per-region detail, the map layers and the deck's tables; returns the folder of each.

    Tables that several outputs need are written once to the shared folder and deleted at the end; a run that fails
    says where they are. ``strict_keys`` refuses inputs
    in which a provider or an area's region repeats, where sums over areas would count twice. ``resume`` keeps the deck's
    tables that an earlier run over the same inputs has completed.
    """
    staging = Staging(inputs.pharm_list.sparkSession)
    pack = WeeklyPack(inputs, as_of, since, service, staging=staging)
    try:
        written = _write_all(pack, staging, out_dir, as_of, strict_keys, resume)
    except Exception as error:
        error.add_note(f"tables of this run are left in {staging.folder}")
        raise
    staging.drop()
    return written


def _write_all(pack: WeeklyPack, staging: Staging, out_dir: str, as_of: date, strict_keys: bool, resume: bool) -> dict[str, str]:
    if strict_keys:
        assert_unique(pack.roster, ["fcode"])
        assert_unique(pack.inputs.hundred_hour, ["fcode"])
        assert_unique(scorecards.region_map(pack.contractor), ["icb_code"])
    tables = (pack.national, pack.regional, scorecards.icb_display(pack.icb_card), pack.pharmacy_list)
    written = write_report(dict(zip(labels.SHEETS, tables, strict=True)), out_dir, as_of)
    written["By region"] = write_by_region(pack.region_detail(), out_dir, as_of)
    written["Map layers"] = write_points(pack.drawn_layers(staging), out_dir, as_of)
    deck = Deck(staging.spark, out_dir, as_of, resume)
    for name, build in pack.deck().items():
        written[f"Deck {name}"] = deck.write(name, build)
    return written
