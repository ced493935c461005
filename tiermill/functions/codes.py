"""Code lists used by the cleaning rules.

Fixed values: the cleaned tables and the domain checks depend on exactly these texts.
"""

UNKNOWN = "n/a"

MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER = {"F": "Female", "M": "Male"}
GENDER_WORDS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}

MISSING_DATE_TEXTS = ("NaN", "NaT")

CREATE_DATE_DEFAULT = "2025-10-07 00:00:00"
START_DATE_DEFAULT = "2007-12-28 00:00:00"
ORDER_DATE_DEFAULT = "2010-12-29 00:00:00"
SHIP_DATE_DEFAULT = "2011-01-05 00:00:00"
DUE_DATE_DEFAULT = "2011-01-10 00:00:00"

MARITAL_DOMAIN = ("Single", "Married", "n/a")
LINE_DOMAIN = ("Other Sales", "Road", "Mountain", "n/a", "Touring")
COUNTRY_DOMAIN = (
    "Australia",
    "Canada",
    "France",
    "Germany",
    "n/a",
    "NaN",
    "United Kingdom",
    "United States",
)
DATE_INT_RANGE = (19000101, 20500101)
