"""Fixed values that must equal the published pipeline's for equal results.

Everything in this module is data, stated plainly and in its natural order:
column names of the four registry exports, the unified output columns, the
legal-suffix lists, the project-category rules, and the three country code
tables. Operators turn these into broadcast lookup frames or SQL expressions.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: registry keys, labels and export column names
# --------------------------------------------------------------------------

REGISTRIES = ["verra", "gold", "acr", "car"]

REGISTRY_LABEL = {"verra": "Verra", "gold": "Gold", "acr": "ACR", "car": "CAR"}

SERIAL_COLUMN = {
    "verra": "Serial Number",
    "gold": "Serial Number",
    "acr": "Credit Serial Numbers",
    "car": "Offset Credit Serial Numbers",
}

# registry-specific column -> unified column
COLUMN_RENAMES = {
    "verra": {
        "Quantity Issued": "quantity",
        "Country/Area": "country",
        "Retirement/Cancellation Date": "retirement_date",
        "Name": "projectname",
        "Project Type": "projecttype",
        "ID": "project_id",
    },
    "gold": {
        "Quantity": "quantity",
        "Country": "country",
        "Retirement Date": "retirement_date",
        "Project Name": "projectname",
        "Project Type": "projecttype",
        "GSID": "project_id",
    },
    "acr": {
        "Quantity of Credits": "quantity",
        "Project Site Country": "country",
        "Status Effective (GMT)": "retirement_date",
        "Project Name": "projectname",
        "Project Type": "projecttype",
        "Project ID": "project_id",
    },
    "car": {
        "Quantity of Offset Credits": "quantity",
        "Project Site Country": "country",
        "Status Effective": "retirement_date",
        "Project Name": "projectname",
        "Project Type": "projecttype",
        "Project ID": "project_id",
    },
}

# Name fields per registry: (primary, fallback, fallback is free text)
VERRA_PRIMARY = "Retirement Beneficiary"
VERRA_DETAILS = "Retirement Details"
GOLD_PRIMARY = "* Using Entity"
GOLD_SECONDARY = "Using Entity"
GOLD_NOTE = "Note"
ACR_PRIMARY = "Retired on Behalf of"
ACR_HOLDER = "Account Holder"
CAR_HOLDER = "Account Holder"
CAR_DETAILS = "Retirement Reason Details"

VINTAGE_START = "Vintage Start"
VINTAGE = "Vintage"

# Date column that marks a real retirement in the snapshot's verra sheet
VERRA_RETIREMENT_DATE = "Retirement/Cancellation Date"

# Snapshot sheet name -> registry key
SNAPSHOT_SHEETS = {
    "Verra VCUS": "verra",
    "Gold Retirements": "gold",
    "ACR Retirements": "acr",
    "CAR Retirements": "car",
}

# Unified output columns, in order
OUTPUT_COLUMNS = [
    "raw_beneficiary", "matched_name", "factset_entity_id", "hq_country", "registry",
    "retirement_year", "country", "quantity", "match_confidence", "match_method",
    "projectname", "projecttype", "vintage", "isocode",
]

# Base dataset column renames and registry value normalisation
BASE_RENAMES = {
    "company": "raw_beneficiary",
    "official_name": "matched_name",
    "retirementdate": "retirement_date_str",
}
BASE_REGISTRY_VALUES = {"Acr": "ACR", "Car": "CAR", "gold": "Gold", "verra": "Verra"}

# Report: date columns tried in order, country columns tried in order
REPORT_DATE_COLUMNS = ["ret_date", "retirementdate", "Retirement/Cancellation Date", "Retirement Date"]
REPORT_COUNTRY_COLUMNS = ["country", "Country/Area", "Country"]
REPORT_QUANTITY_COLUMNS = ["quantity", "Quantity"]
REPORT_DISPLAY_COLUMNS = [
    "matched_name", "hq_country_name", "registry",
    "retirement_year", "country", "Country/Area", "quantity", "Quantity",
    "projectname", "projecttype", "vintage",
]
REPORT_EXCLUDED_EXPORT_COLUMNS = ["rating_msci", "numrating_msci"]

# Firm universe columns kept from the entity coverage table
FIRM_COLUMNS = [
    "factset_entity_id", "entity_name", "entity_proper_name",
    "iso_country", "sector_code", "industry_code", "primary_sic_code",
]
IDENTIFIER_TYPES = ["ISIN", "LEI"]

# Match confidence rank used by the cache update threshold
CONFIDENCE_RANK = {"high": 3, "medium": 2, "low": 1, "none": 0}

# --------------------------------------------------------------------------
# FIXED VALUES: legal suffixes (configured list, then the built-in default)
# --------------------------------------------------------------------------

LEGAL_SUFFIXES_CONFIG = [
    "inc", "incorporated", "corp", "corporation", "ltd", "limited", "llc", "llp", "lp",
    "plc", "sa", "s.a.", "s.a", "se", "ag", "gmbh", "co", "company", "group", "holdings",
    "holding", "nv", "n.v.", "bv", "b.v.", "pty", "pte", "srl", "s.r.l.", "spa", "s.p.a.",
    "ab", "asa", "as", "a/s", "oyj", "tbk", "bhd", "sdn", "sarl", "kk", "kabushiki kaisha",
]

LEGAL_SUFFIXES_DEFAULT = [
    "inc", "incorporated", "corp", "corporation", "ltd", "limited",
    "llc", "llp", "lp", "plc", "sa", "se", "ag", "gmbh", "co",
    "company", "group", "holdings", "holding", "nv", "bv", "pty",
    "pte", "srl", "spa", "ab", "asa", "as", "oyj", "tbk", "bhd",
    "sdn", "sarl", "kk", "kabushiki kaisha",
]

# --------------------------------------------------------------------------
# FIXED VALUES: project-type categories, ordered rules, first hit wins
# --------------------------------------------------------------------------

PROJECT_CATEGORY_RULES = [
    ("Forestry & Land Use", ["forest", "a/r", "redd", "afforestation", "avoided conversion", "avoided grassland"]),
    ("Agriculture & Livestock", ["agriculture", "soil", "agricultural", "livestock", "manure"]),
    ("Renewable Energy", ["renewable", "wind", "solar", "hydro", "geothermal", "biomass", "biogas", "biofuel"]),
    ("Energy Efficiency", ["energy efficiency", "energy demand", "energy distribution"]),
    ("Waste Management", ["landfill", "waste", "composting", "digestion"]),
    ("Industrial Processes", ["industrial", "manufacturing", "mining", "chemical", "adipic", "nitric", "cement"]),
    ("Ozone & Industrial Gases", ["ozone", "halocarbon", "hfc", "refrigerant", "industrial gas"]),
    ("Transport", ["transport", "fleet"]),
    ("Carbon Capture", ["carbon capture", "ccs"]),
]
PROJECT_CATEGORY_DEFAULT = "Other"

# --------------------------------------------------------------------------
# FIXED VALUES: report country clean-up
# --------------------------------------------------------------------------

COUNTRY_RENAMES = {
    "Congo, The Democratic Republic of The": "DR Congo",
    "Congo, the Democratic Republic of the": "DR Congo",
    "Korea, Republic of": "South Korea",
    "Tanzania, United Republic of": "Tanzania",
    "Lao People's Democratic Republic": "Laos",
}

# --------------------------------------------------------------------------
# FIXED VALUES: country name -> ISO3 (project map)
# --------------------------------------------------------------------------

COUNTRY_TO_ISO3 = {
    "Afghanistan": "AFG", "Albania": "ALB", "Algeria": "DZA", "Argentina": "ARG",
    "Armenia": "ARM", "Australia": "AUS", "Austria": "AUT", "Azerbaijan": "AZE",
    "Bangladesh": "BGD", "Belarus": "BLR", "Belgium": "BEL", "Belize": "BLZ",
    "Benin": "BEN", "Bhutan": "BTN", "Bolivia": "BOL", "Bosnia and Herzegovina": "BIH",
    "Botswana": "BWA", "Brazil": "BRA", "Brunei": "BRN", "Bulgaria": "BGR",
    "Burkina Faso": "BFA", "Burundi": "BDI", "Cambodia": "KHM", "Cameroon": "CMR",
    "Canada": "CAN", "Central African Republic": "CAF", "Chad": "TCD", "Chile": "CHL",
    "China": "CHN", "Colombia": "COL", "Comoros": "COM", "Congo": "COG",
    "Costa Rica": "CRI", "Croatia": "HRV", "Cuba": "CUB", "Cyprus": "CYP",
    "Czech Republic": "CZE", "Czechia": "CZE",
    "Democratic Republic of the Congo": "COD", "Dem. Rep. Congo": "COD",
    "Congo, The Democratic Republic of The": "COD", "DR Congo": "COD",
    "Denmark": "DNK", "Djibouti": "DJI", "Dominican Republic": "DOM",
    "Ecuador": "ECU", "Egypt": "EGY", "El Salvador": "SLV", "Equatorial Guinea": "GNQ",
    "Eritrea": "ERI", "Estonia": "EST", "Eswatini": "SWZ", "Ethiopia": "ETH",
    "Fiji": "FJI", "Finland": "FIN", "France": "FRA", "Gabon": "GAB", "Gambia": "GMB",
    "Georgia": "GEO", "Germany": "DEU", "Ghana": "GHA", "Greece": "GRC",
    "Guatemala": "GTM", "Guinea": "GIN", "Guinea-Bissau": "GNB", "Guyana": "GUY",
    "Haiti": "HTI", "Honduras": "HND", "Hungary": "HUN", "Iceland": "ISL",
    "India": "IND", "Indonesia": "IDN", "Iran": "IRN", "Iraq": "IRQ", "Ireland": "IRL",
    "Israel": "ISR", "Italy": "ITA", "Ivory Coast": "CIV", "Cote d'Ivoire": "CIV",
    "Jamaica": "JAM", "Japan": "JPN", "Jordan": "JOR", "Kazakhstan": "KAZ",
    "Kenya": "KEN", "Korea, South": "KOR", "South Korea": "KOR",
    "Korea, Republic of": "KOR", "Kuwait": "KWT",
    "Kyrgyzstan": "KGZ", "Laos": "LAO", "Lao People's Democratic Republic": "LAO",
    "Latvia": "LVA", "Lebanon": "LBN", "Lesotho": "LSO", "Liberia": "LBR",
    "Libya": "LBY", "Lithuania": "LTU", "Luxembourg": "LUX",
    "Madagascar": "MDG", "Malawi": "MWI", "Malaysia": "MYS", "Maldives": "MDV",
    "Mali": "MLI", "Malta": "MLT", "Mauritania": "MRT", "Mauritius": "MUS",
    "Mexico": "MEX", "Moldova": "MDA", "Mongolia": "MNG", "Montenegro": "MNE",
    "Morocco": "MAR", "Mozambique": "MOZ", "Myanmar": "MMR", "Namibia": "NAM",
    "Nepal": "NPL", "Netherlands": "NLD", "New Zealand": "NZL", "Nicaragua": "NIC",
    "Niger": "NER", "Nigeria": "NGA", "North Macedonia": "MKD", "Norway": "NOR",
    "Oman": "OMN", "Pakistan": "PAK", "Palestine": "PSE", "Panama": "PAN",
    "Papua New Guinea": "PNG", "Paraguay": "PRY", "Peru": "PER", "Philippines": "PHL",
    "Poland": "POL", "Portugal": "PRT", "Qatar": "QAT", "Romania": "ROU",
    "Russia": "RUS", "Russian Federation": "RUS", "Rwanda": "RWA",
    "Saudi Arabia": "SAU", "Senegal": "SEN", "Serbia": "SRB", "Sierra Leone": "SLE",
    "Singapore": "SGP", "Slovakia": "SVK", "Slovenia": "SVN", "Solomon Islands": "SLB",
    "Somalia": "SOM", "South Africa": "ZAF", "South Sudan": "SSD", "Spain": "ESP",
    "Sri Lanka": "LKA", "Sudan": "SDN", "Suriname": "SUR", "Sweden": "SWE",
    "Switzerland": "CHE", "Syria": "SYR", "Taiwan": "TWN",
    "Tajikistan": "TJK", "Tanzania": "TZA", "United Republic of Tanzania": "TZA",
    "Thailand": "THA", "Timor-Leste": "TLS", "Togo": "TGO",
    "Trinidad and Tobago": "TTO", "Tunisia": "TUN", "Turkey": "TUR", "Turkiye": "TUR",
    "Turkmenistan": "TKM", "Uganda": "UGA", "Ukraine": "UKR",
    "United Arab Emirates": "ARE", "United Kingdom": "GBR",
    "United States": "USA", "United States of America": "USA",
    "Uruguay": "URY", "Uzbekistan": "UZB", "Vanuatu": "VUT",
    "Venezuela": "VEN", "Vietnam": "VNM", "Viet Nam": "VNM",
    "Yemen": "YEM", "Zambia": "ZMB", "Zimbabwe": "ZWE",
}

# --------------------------------------------------------------------------
# FIXED VALUES: ISO2 -> ISO3 (HQ map)
# --------------------------------------------------------------------------

ISO2_TO_ISO3 = {
    "US": "USA", "BR": "BRA", "DE": "DEU", "GB": "GBR", "AU": "AUS", "JP": "JPN",
    "FR": "FRA", "CH": "CHE", "CN": "CHN", "CO": "COL", "KR": "KOR", "IN": "IND",
    "IT": "ITA", "CA": "CAN", "ES": "ESP", "NL": "NLD", "SE": "SWE", "NO": "NOR",
    "DK": "DNK", "FI": "FIN", "AT": "AUT", "BE": "BEL", "IE": "IRL", "PT": "PRT",
    "MX": "MEX", "CL": "CHL", "ZA": "ZAF", "NZ": "NZL", "SG": "SGP", "HK": "HKG",
    "TW": "TWN", "TH": "THA", "MY": "MYS", "ID": "IDN", "PH": "PHL", "TR": "TUR",
    "PL": "POL", "CZ": "CZE", "HU": "HUN", "RO": "ROU", "GR": "GRC", "IL": "ISR",
    "AE": "ARE", "SA": "SAU", "RU": "RUS", "UA": "UKR", "AR": "ARG", "PE": "PER",
    "KE": "KEN", "NG": "NGA", "EG": "EGY", "PK": "PAK", "BD": "BGD", "VN": "VNM",
    "LU": "LUX", "PA": "PAN", "CR": "CRI", "GT": "GTM", "BM": "BMU", "JE": "JEY",
    "KY": "CYM", "LR": "LBR", "MU": "MUS",
}

# --------------------------------------------------------------------------
# FIXED VALUES: ISO2 -> country name (report)
# --------------------------------------------------------------------------

ISO2_TO_NAME = {
    "AE": "United Arab Emirates", "AR": "Argentina", "AT": "Austria", "AU": "Australia",
    "BD": "Bangladesh", "BE": "Belgium", "BM": "Bermuda", "BR": "Brazil", "CA": "Canada", "CD": "DR Congo",
    "CH": "Switzerland", "CL": "Chile", "CN": "China", "CO": "Colombia", "CR": "Costa Rica",
    "CY": "Cyprus", "CZ": "Czech Republic", "DE": "Germany", "DK": "Denmark", "EG": "Egypt",
    "ES": "Spain", "FI": "Finland", "FR": "France", "GB": "United Kingdom", "GR": "Greece",
    "GT": "Guatemala", "HK": "Hong Kong", "HU": "Hungary", "ID": "Indonesia", "IE": "Ireland",
    "IL": "Israel", "IN": "India", "IT": "Italy", "JE": "Jersey", "JP": "Japan",
    "KE": "Kenya", "KR": "South Korea", "KY": "Cayman Islands", "LR": "Liberia",
    "LU": "Luxembourg", "MU": "Mauritius", "MX": "Mexico", "MY": "Malaysia", "NG": "Nigeria",
    "NL": "Netherlands", "NO": "Norway", "NZ": "New Zealand", "PA": "Panama", "PE": "Peru",
    "PH": "Philippines", "PK": "Pakistan", "PL": "Poland", "PT": "Portugal", "RO": "Romania",
    "RU": "Russia", "SA": "Saudi Arabia", "SE": "Sweden", "SG": "Singapore", "TH": "Thailand",
    "TR": "Turkey", "TW": "Taiwan", "UA": "Ukraine", "US": "United States", "VN": "Vietnam",
    "ZA": "South Africa",
}
