"""Display texts, codes and cut-offs the reports must carry exactly."""

from __future__ import annotations

# Service keys used inside the engine.
PHARM1ST = "pharm1st"
CONTRACEPTION = "contraception"
BP = "bp"
SIGNUP_GAP = "signup_gap"

# Register rules.
PHARMACY = "Pharmacy"
EXCLUDED_CONTRACT = "DAC"
HUNDRED_HOUR_YES = "Yes"
AREA_RECODES = {"Q62": "QRV"}
UNKNOWN_REGION = "Region Unknown"
UNKNOWN_AREA_RECONCILE = "ICB unknown"
UNKNOWN_AREA_DETAIL = "ICB Unknown"
CPCS_SERVICE = "Community Pharmacy Consultation Service"

# Legend text of each weekly series, spelled as published.
SERIES_LABELS = {
    "pharm1st": "Pharmacy First Opt-In",
    "contraception": "Contraception Opt-In",
    "bp": "BP check service signup since 01Dec2023",
    "pharm1st_100h": "Pharmacy First Opt-In (100-hour phmarcy only)",
}

# Short region labels. "North West" is published as "NE", which looks like a typing slip
# for "NW"; pass another mapping to change it. Any region not listed is published as "LDN".
REGION_SHORT = {
    "North East And Yorkshire": "NEY",
    "South West": "SW",
    "East Of England": "EoE",
    "North West": "NE",
    "South East": "SE",
    "Midlands": "Mids",
}
REGION_SHORT_OTHER = "LDN"

# Heads of map titles; a day follows.
GAP_MAP_TITLE = "% of contractors signed up for CPCS but not opt in  to Pharmacy First at ICB Level as on "
AREA_MAP_TITLE = "% of contractors opted in to {} service at ICB Level as on "
POINT_MAP_TITLE = "Pharmacies opted in for {} as on "

# Names of the report's sheets.
SHEETS = ("National", "Regional", "ICB", "Pharmacy Level")

# Names used in map titles.
AREA_MAP_SERVICE = {"pharm1st": "Pharmacy First", "contraception": "Contraception"}
POINT_MAP_SERVICE = {
    "pharm1st": "Pharmacy First Service",
    "contraception": "Contraception Service",
}

# Legend text of each colour on the provider maps.
LEGEND = {
    "pharm1st": {
        "Green": "Opted in to PharmFirst and also registered for CPCS",
        "Amber": "Opted in to PharmFirst but not registered for CPCS",
        "Red": "Not opted in to PharmFirst yet",
    },
    "contraception": {
        "Green": "Opted in to Contraception Service",
        "Red": "Not opted in to Contraception Service yet",
    },
}

# Column headings of the published tables.
DISPLAY = {
    "total_contractors": "Total contractors",
    "pharm1st_opted_in": "No of contractors opted in Pharmacy First",
    "pct_pharm1st": "% of contractors opted in Pharm1st",
    "contraception_opted_in": "No of contractors opted in Contraception",
    "pct_contraception": "% of contractors opted in Contraception",
    "bp_new": "New BPcheck service signups since 1stDec2023",
    "total_100_hour": "No of 100-hour contractors",
    "pharm1st_100_hour": "No of 100-hour contractors opted in Pharm First",
    "pct_pharm1st_100_hour": "% of 100-hour contractors opted in Pharm1st",
    "signed_not_opted": "No of CPCS signups not opted-in Pharm1st",
    "pct_signed_not_opted": "% of contractors signed up for CPCS but not opted in Pharm First",
    "opted_not_registered": "No of Pharm1st Opt-Ins not registered for CPCS",
    "pct_opted_not_registered": "% of contractors opted in Pharm1st but not registered for CPCS",
    "icb": "ICB",
    "region": "Region",
    "region_name": "Region_Name",
    "region_code": "RegionCode",
    "icb_code": "ICB_Code",
    "fcode": "contractors signed up for CPCS but not opted in Pharm1st",
    "trading_name": "Pharmacy Trading Name",
    "organisation_name": "Organisation Name",
}
# Headings that differ on the national sheet.
DISPLAY_NATIONAL = {
    **DISPLAY,
    "pharm1st_opted_in": "No of contractors opted in Pharm First",
    "total_100_hour": "Total 100-hour contractors",
    "pharm1st_100_hour": "No of 100-hour contractors opted in Pharm1st",
}
