"""Tables of records: keys, references, unique keys and column types."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Fk:
    field: str
    target: str
    optional: bool = False


@dataclass(frozen=True)
class TableSpec:
    """``columns``: name -> (type, required); types: string, int, long, decimal, date, timestamp, uuid, json."""

    name: str
    pk: str
    fks: tuple[Fk, ...] = ()
    unique_keys: tuple[tuple[str, ...], ...] = ()
    columns: dict[str, tuple[str, bool]] = field(default_factory=dict)
    self_fk: str | None = None

    def aliases(self) -> dict[str, str]:
        """Snake-case field name -> column."""
        return {"".join("_" + c.lower() if c.isupper() else c for c in n): n for n in self.columns}


def _columns(text: str) -> dict[str, tuple[str, bool]]:
    """``name type?``, comma-separated; a question mark makes the column optional."""
    out = {}
    for part in text.split(","):
        name, kind = part.split()
        out[name] = (kind.rstrip("?"), not kind.endswith("?"))
    return out


#: The 17 tables in load order, parents first.
SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec("City", "cityId", columns=_columns("cityId uuid, cityName string, country string, locode string?, areaKm2 decimal?, notes string?, misc json?")),
        TableSpec("Sector", "sectorId", columns=_columns("sectorId uuid, sectorName string, description string?, notes string?, misc json?")),
        TableSpec("CityAnnualStats", "statId", (Fk("cityId", "City"),), (("cityId", "year"),), _columns("statId uuid?, cityId uuid?, year int, population int?, populationDensity decimal?, gdpPerCapita decimal?, notes string?, misc json?")),
        TableSpec("ClimateCityContract", "climateCityContractId", (Fk("cityId", "City"),), (("cityId",),), _columns("climateCityContractId uuid?, cityId uuid?, contractDate timestamp, title string, version string?, language string?, documentUrl string?, notes string?, misc json?")),
        TableSpec("EmissionRecord", "emissionRecordId", (Fk("cityId", "City"), Fk("sectorId", "Sector")), (("cityId", "year", "sectorId", "scope", "ghgType"),), _columns("emissionRecordId uuid?, cityId uuid?, year int, sectorId uuid?, scope string, ghgType string, value int, unit string, notes string?, misc json?")),
        TableSpec("CityBudget", "budgetId", (Fk("cityId", "City"),), (), _columns("budgetId uuid?, cityId uuid?, year int, totalAmount long, currency string, description string?, notes string?, misc json?")),
        TableSpec("FundingSource", "fundingSourceId", columns=_columns("fundingSourceId uuid, name string, type string, description string?, notes string?, misc json?")),
        TableSpec("BudgetFunding", "budgetFundingId", (Fk("budgetId", "CityBudget"), Fk("fundingSourceId", "FundingSource")), (), _columns("budgetFundingId uuid?, budgetId uuid?, fundingSourceId uuid?, amount long, currency string, notes string?, misc json?")),
        TableSpec("Initiative", "initiativeId", (Fk("cityId", "City"),), (), _columns("initiativeId uuid?, cityId uuid?, title string, description string?, startYear int?, endYear int?, totalEstimatedCost long?, currency string?, status string?, notes string?, misc json?")),
        TableSpec("Stakeholder", "stakeholderId", columns=_columns("stakeholderId uuid, name string, type string?, description string?, notes string?, misc json?")),
        TableSpec("InitiativeStakeholder", "initiativeStakeholderId", (Fk("initiativeId", "Initiative"), Fk("stakeholderId", "Stakeholder")), (("initiativeId", "stakeholderId"),), _columns("initiativeStakeholderId uuid?, initiativeId uuid?, stakeholderId uuid?, role string?, notes string?, misc json?")),
        TableSpec("Indicator", "indicatorId", (Fk("cityId", "City"), Fk("sectorId", "Sector", True)), (), _columns("indicatorId uuid?, cityId uuid?, sectorId uuid?, name string, description string?, unit string, notes string?, misc json?")),
        TableSpec("IndicatorValue", "indicatorValueId", (Fk("indicatorId", "Indicator"),), (("indicatorId", "year"),), _columns("indicatorValueId uuid?, indicatorId uuid?, year int, value decimal, valueType string, notes string?, misc json?")),
        TableSpec("CityTarget", "cityTargetId", (Fk("cityId", "City"), Fk("indicatorId", "Indicator")), (), _columns("cityTargetId uuid?, cityId uuid?, indicatorId uuid?, description string, targetYear date, targetValue decimal, baselineYear date?, baselineValue decimal?, status string, notes string?, misc json?")),
        TableSpec("InitiativeIndicator", "initiativeIndicatorId", (Fk("initiativeId", "Initiative"), Fk("indicatorId", "Indicator")), (("initiativeId", "indicatorId"),), _columns("initiativeIndicatorId uuid?, initiativeId uuid?, indicatorId uuid?, contributionType string, expectedChange decimal?, notes string?, misc json?")),
        TableSpec("TefCategory", "tefId", (Fk("parentId", "TefCategory", True),), (), _columns("tefId uuid?, parentId uuid?, code string, name string, description string?, misc json?"), "parentId"),
        TableSpec("InitiativeTef", "initiativeTefId", (Fk("initiativeId", "Initiative"), Fk("tefId", "TefCategory")), (("initiativeId", "tefId"),), _columns("initiativeTefId uuid?, initiativeId uuid?, tefId uuid?, notes string?, misc json?")),
    )
}

#: How rows without a cityId belong to a city: table -> (fk, parent table).
CITY_CHAIN: dict[str, tuple[str, str]] = {
    "BudgetFunding": ("budgetId", "CityBudget"),
    "InitiativeStakeholder": ("initiativeId", "Initiative"),
    "IndicatorValue": ("indicatorId", "Indicator"),
    "InitiativeIndicator": ("initiativeId", "Initiative"),
    "InitiativeTef": ("initiativeId", "Initiative"),
}
SHARED = ("Sector", "FundingSource", "Stakeholder", "TefCategory")
