"""Input tables: internal columns, their types, and the headings they have when landed from sheets."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    """One input column: internal name, Spark type, landed heading, and date style if it comes as text."""

    name: str
    type: str
    heading: str
    style: str = "ymd"


def _text(name: str, heading: str) -> Field:
    return Field(name, "string", heading)


def _day(name: str, heading: str, style: str = "ymd") -> Field:
    return Field(name, "date", heading, style)


_CONTACT = [
    _text("icb_code", "ICB.Code"),
    _text("name", "Name"),
    _text("phone", "F.code.Phone.Number"),
    _text("lpc_code", "LPC.Code"),
    _text("lpc_name", "LPC.Name"),
]

# Headings of the landed inputs.
SCHEMAS: dict[str, list[Field]] = {
    "ref_contractor": [
        _text("fcode", "ContractorCode"),
        _text("contractor_type", "ContractorType"),
        _text("contract_type", "ContractType"),
        _text("stp", "STP"),
        _text("region_code", "RegionCode"),
        _text("region_name", "Region_Name"),
        _day("end_date", "EndDate"),
    ],
    "pharm_list": [
        _text("fcode", "Pharmacy ODS Code (F-Code)"),
        _day("snapshot_month", "SnapshotMonth"),
        _text("postcode", "Post Code"),
        _text("stp_code", "STP Code"),
        _text("icb_name", "STP Name"),
        _text("hwb", "Health and Wellbeing Board"),
        _text("trading_name", "Pharmacy Trading Name"),
        _text("organisation_name", "Organisation Name"),
    ],
    "hundred_hour": [_text("fcode", "FCode"), _text("hundred_hour", "100 Hour Pharmacy")],
    "icb_short": [_text("icb_code", "ICB_Code"), _text("short_icb_name", "Short_ICB_Name")],
    "pharm1st": [
        _text("ods_code", "ODS.Code"),
        Field("opted_in", "boolean", "Opted.In"),
        _day("opt_in_date", "Opt.In.Date", "dmy"),
        Field("registered_for_cpcs", "boolean", "Registered.for.CPCS"),
        *_CONTACT,
    ],
    "contraception_opt": [
        _text("ods_code", "ODS.Code"),
        Field("opted_in", "boolean", "Opted.In"),
        _day("opt_in_date", "Opt.In.Date"),
        *_CONTACT,
    ],
    "contraception_reg": [_text("fcode", "F.Code"), _day("reg_date", "Date"), *_CONTACT],
    "contraception_dereg": [
        _text("ods_code", ""),
        _day("date_dereg", ""),
        _day("date_notice", ""),
        _day("service_end", ""),
        _text("icb", ""),
        _text("area", ""),
    ],
    "bp_reg": [_text("fcode", "F.Code"), _day("reg_date", "Date", "dmy"), _text("icb_code", "ICB.Code")],
    "service_registrations": [
        _text("fcode", "FCode"),
        _text("service", "Service"),
        _day("date_reported", "DateReported"),
        _day("registration_date", "RegistrationDate", "dmy"),
    ],
    "service_deregistrations": [
        _text("fcode", "FCode"),
        _text("service", "Service"),
        _day("date_reported", "DateReported"),
        _day("re_registration_date", "ReRegistrationDate"),
    ],
    "postcodes": [
        _text("postcode", "pcds"),
        Field("easting", "double", "oseast1m"),
        Field("northing", "double", "osnrth1m"),
    ],
}

# Leading text of each landed file name.
PREFIXES = {
    "pharm1st": "pharmacy first",
    "contraception_opt": "contraception service",
    "contraception_reg": "contraception re",
    "contraception_dereg": "contraception de",
    "bp_reg": "hypertension",
}

# Columns of this input are known by position, not by heading.
POSITIONAL = {"contraception_dereg"}
