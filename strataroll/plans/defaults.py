"""Fixed values of the vehicle-registration job."""

from strataroll.functions.cells import EPOCH_DATE

# Columns read from the documents, with the types they are given.
COLUMNS = {
    "VIN (1-10)": "string",
    "County": "string",
    "City": "string",
    "State": "string",
    "Postal Code": "string",
    "Model Year": "int",
    "Make": "string",
    "Model": "string",
    "Electric Vehicle Type": "string",
    "Clean Alternative Fuel Vehicle (CAFV) Eligibility": "string",
    "Electric Range": "int",
    "Base MSRP": "double",
    "Legislative District": "string",
    "DOL Vehicle ID": "string",
    "Vehicle Location": "string",
    "Electric Utility": "string",
    "2020 Census Tract": "string",
    "Counties": "string",
    "Congressional Districts": "string",
    "WAOFM - GIS - Legislative District Boundary": "string",
    "created_at": EPOCH_DATE,
    "updated_at": EPOCH_DATE,
}

# Business key and the columns that tell of a change, oldest kind first.
KEY = "DOL Vehicle ID"
CHANGE_COLUMNS = ["created_at", "updated_at"]

# Quality thresholds.
CRITICAL = ["VIN (1-10)", "Make", "Model"]
RANGES = {
    "Electric Range": (0, 1000),
    "Model Year": (2000, 2025),
    "Base MSRP": (0, 200000),
}
UNIQUE = ["DOL Vehicle ID"]
