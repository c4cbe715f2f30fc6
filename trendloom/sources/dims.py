"""Code dimensions: geos, categories, periods, sort options, properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The supported codes and their names.  All tables below are
# closed lists of under 130 entries, so their DataFrames may be broadcast.
COUNTRIES = [
    ("AL", "Albania"),
    ("DZ", "Algeria"),
    ("AO", "Angola"),
    ("AR", "Argentina"),
    ("AM", "Armenia"),
    ("AU", "Australia"),
    ("AT", "Austria"),
    ("AZ", "Azerbaijan"),
    ("BH", "Bahrain"),
    ("BD", "Bangladesh"),
    ("BY", "Belarus"),
    ("BE", "Belgium"),
    ("BJ", "Benin"),
    ("BO", "Bolivia"),
    ("BA", "Bosnia & Herzegovina"),
    ("BR", "Brazil"),
    ("BG", "Bulgaria"),
    ("BF", "Burkina Faso"),
    ("KH", "Cambodia"),
    ("CM", "Cameroon"),
    ("CA", "Canada"),
    ("CL", "Chile"),
    ("CO", "Colombia"),
    ("CD", "Congo - Kinshasa"),
    ("CR", "Costa Rica"),
    ("CI", "Côte d'Ivoire"),
    ("HR", "Croatia"),
    ("CU", "Cuba"),
    ("CY", "Cyprus"),
    ("CZ", "Czechia"),
    ("DK", "Denmark"),
    ("DO", "Dominican Republic"),
    ("EC", "Ecuador"),
    ("EG", "Egypt"),
    ("SV", "El Salvador"),
    ("EE", "Estonia"),
    ("ET", "Ethiopia"),
    ("FI", "Finland"),
    ("FR", "France"),
    ("GE", "Georgia"),
    ("DE", "Germany"),
    ("GH", "Ghana"),
    ("GR", "Greece"),
    ("GT", "Guatemala"),
    ("HT", "Haiti"),
    ("HN", "Honduras"),
    ("HK", "Hong Kong"),
    ("HU", "Hungary"),
    ("IN", "India"),
    ("ID", "Indonesia"),
    ("IR", "Iran"),
    ("IQ", "Iraq"),
    ("IE", "Ireland"),
    ("IL", "Israel"),
    ("IT", "Italy"),
    ("JM", "Jamaica"),
    ("JP", "Japan"),
    ("JO", "Jordan"),
    ("KZ", "Kazakhstan"),
    ("KE", "Kenya"),
    ("KW", "Kuwait"),
    ("KG", "Kyrgyzstan"),
    ("LV", "Latvia"),
    ("LB", "Lebanon"),
    ("LY", "Libya"),
    ("LT", "Lithuania"),
    ("MY", "Malaysia"),
    ("ML", "Mali"),
    ("MX", "Mexico"),
    ("MD", "Moldova"),
    ("MA", "Morocco"),
    ("MZ", "Mozambique"),
    ("MM", "Myanmar (Burma)"),
    ("NP", "Nepal"),
    ("NL", "Netherlands"),
    ("NZ", "New Zealand"),
    ("NI", "Nicaragua"),
    ("NG", "Nigeria"),
    ("MK", "North Macedonia"),
    ("NO", "Norway"),
    ("OM", "Oman"),
    ("PK", "Pakistan"),
    ("PS", "Palestine"),
    ("PA", "Panama"),
    ("PY", "Paraguay"),
    ("PE", "Peru"),
    ("PH", "Philippines"),
    ("PL", "Poland"),
    ("PT", "Portugal"),
    ("PR", "Puerto Rico"),
    ("QA", "Qatar"),
    ("RO", "Romania"),
    ("RU", "Russia"),
    ("SA", "Saudi Arabia"),
    ("SN", "Senegal"),
    ("RS", "Serbia"),
    ("SG", "Singapore"),
    ("SK", "Slovakia"),
    ("SI", "Slovenia"),
    ("ZA", "South Africa"),
    ("KR", "South Korea"),
    ("ES", "Spain"),
    ("LK", "Sri Lanka"),
    ("SE", "Sweden"),
    ("CH", "Switzerland"),
    ("SY", "Syria"),
    ("TW", "Taiwan"),
    ("TZ", "Tanzania"),
    ("TH", "Thailand"),
    ("TT", "Trinidad & Tobago"),
    ("TN", "Tunisia"),
    ("TR", "Türkiye"),
    ("TM", "Turkmenistan"),
    ("UG", "Uganda"),
    ("UA", "Ukraine"),
    ("AE", "United Arab Emirates"),
    ("GB", "United Kingdom"),
    ("US", "United States"),
    ("UY", "Uruguay"),
    ("UZ", "Uzbekistan"),
    ("VE", "Venezuela"),
    ("VN", "Vietnam"),
    ("YE", "Yemen"),
    ("ZM", "Zambia"),
    ("ZW", "Zimbabwe"),
]
US_STATES = [
    ("US-AL", "Alabama"),
    ("US-AK", "Alaska"),
    ("US-AZ", "Arizona"),
    ("US-AR", "Arkansas"),
    ("US-CA", "California"),
    ("US-CO", "Colorado"),
    ("US-CT", "Connecticut"),
    ("US-DE", "Delaware"),
    ("US-DC", "District of Columbia"),
    ("US-FL", "Florida"),
    ("US-GA", "Georgia"),
    ("US-HI", "Hawaii"),
    ("US-ID", "Idaho"),
    ("US-IL", "Illinois"),
    ("US-IN", "Indiana"),
    ("US-IA", "Iowa"),
    ("US-KS", "Kansas"),
    ("US-KY", "Kentucky"),
    ("US-LA", "Louisiana"),
    ("US-ME", "Maine"),
    ("US-MD", "Maryland"),
    ("US-MA", "Massachusetts"),
    ("US-MI", "Michigan"),
    ("US-MN", "Minnesota"),
    ("US-MS", "Mississippi"),
    ("US-MO", "Missouri"),
    ("US-MT", "Montana"),
    ("US-NE", "Nebraska"),
    ("US-NV", "Nevada"),
    ("US-NH", "New Hampshire"),
    ("US-NJ", "New Jersey"),
    ("US-NM", "New Mexico"),
    ("US-NY", "New York"),
    ("US-NC", "North Carolina"),
    ("US-ND", "North Dakota"),
    ("US-OH", "Ohio"),
    ("US-OK", "Oklahoma"),
    ("US-OR", "Oregon"),
    ("US-PA", "Pennsylvania"),
    ("US-RI", "Rhode Island"),
    ("US-SC", "South Carolina"),
    ("US-SD", "South Dakota"),
    ("US-TN", "Tennessee"),
    ("US-TX", "Texas"),
    ("US-UT", "Utah"),
    ("US-VT", "Vermont"),
    ("US-VA", "Virginia"),
    ("US-WA", "Washington"),
    ("US-WV", "West Virginia"),
    ("US-WI", "Wisconsin"),
    ("US-WY", "Wyoming"),
]
CATEGORIES = (
    "all", "autos", "beauty", "business", "climate", "entertainment", "food", "games", "health", "hobbies",
    "jobs", "law", "other", "pets", "politics", "science", "shopping", "sports", "technology", "travel",
)
PERIOD_HOURS = (4, 24, 48, 168)
SORT_OPTIONS = ("relevance", "title", "volume", "recency")
GPROPS = ("", "images", "news", "youtube", "froogle")


def geo_dim(spark: SparkSession) -> DataFrame:
    """``pos, code, name, kind`` of all countries, then all US states."""
    rows = [(c, n, "country") for c, n in COUNTRIES]
    rows += [(c, n, "us_state") for c, n in US_STATES]
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)], "pos INT, code STRING, name STRING, kind STRING"
    )


def category_dim(spark: SparkSession) -> DataFrame:
    """``pos, code, name`` of the export categories."""
    return spark.createDataFrame(
        [(i, c, c) for i, c in enumerate(CATEGORIES)], "pos INT, code STRING, name STRING"
    )


def supported_options(spark: SparkSession) -> DataFrame:
    """Everything a request may name: ``option, pos, code, name``."""
    rows = [("country", i, c, n) for i, (c, n) in enumerate(COUNTRIES)]
    rows += [("us_state", i, c, n) for i, (c, n) in enumerate(US_STATES)]
    rows += [("category", i, c, c) for i, c in enumerate(CATEGORIES)]
    rows += [("hours", i, str(h), f"past {h} hours") for i, h in enumerate(PERIOD_HOURS)]
    rows += [("sort", i, s, s) for i, s in enumerate(SORT_OPTIONS)]
    rows += [("gprop", i, g, g or "web") for i, g in enumerate(GPROPS)]
    return spark.createDataFrame(rows, "option STRING, pos INT, code STRING, name STRING")
