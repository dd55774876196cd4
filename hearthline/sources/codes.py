"""Code lists of the homeless-services extracts."""

from __future__ import annotations

# Destination code, description, group, outcome, whether with a subsidy.
DESTINATIONS = [
    (15, "Foster care home or foster care group home", "Institutional", "Other Exit", False),
    (6, "Hospital or other residential non-psychiatric medical facility",
     "Institutional", "Other Exit", False),
    (7, "Jail, prison or juvenile detention facility", "Institutional", "Other Exit", False),
    (4, "Psychiatric hospital or other psychiatric facility", "Institutional", "Other Exit", False),
    (5, "Substance abuse treatment facility or detox center", "Institutional", "Other Exit", False),
    (29, "Residential project or halfway house with no homeless criteria",
     "Institutional", "Other Exit", False),
    (8, "Client doesn't know", "Other", "Other Exit", False),
    (9, "Client refused", "Other", "Other Exit", False),
    (99, "Data not collected", "Other", "Other Exit", False),
    (24, "Deceased", "Other", "Other Exit", False),
    (30, "No exit interview completed", "Other", "Other Exit", False),
    (17, "Other", "Other", "Other Exit", False),
    (1, "Emergency shelter, including hotel or motel paid for with emergency shelter voucher",
     "Temporary", "Other Exit", False),
    (14, "Hotel or motel paid for without emergency shelter voucher",
     "Temporary", "Other Exit", False),
    (16, "Place not meant for habitation (e.g., a vehicle, an abandoned building, bus/train/subway station/airport or anywhere outside)",
     "Temporary", "Other Exit", False),
    (27, "Moved from one HOPWA funded project to HOPWA TH", "Temporary", "Other Exit", False),
    (18, "Safe Haven", "Temporary", "Other Exit", False),
    (12, "Staying or living with family, temporary tenure (e.g., room, apartment or house)",
     "Temporary", "Other Exit", False),
    (13, "Staying or living with friends, temporary tenure (e.g., room, apartment or house)",
     "Temporary", "Other Exit", False),
    (2, "Transitional housing for homeless persons (including homeless youth)",
     "Temporary", "Other Exit", False),
    (25, "Long-term care facility or nursing home", "Permanent", "Successful Exit", False),
    (26, "Moved from one HOPWA funded project to HOPWA PH", "Permanent", "Successful Exit", True),
    (11, "Owned by client, no ongoing housing subsidy", "Permanent", "Successful Exit", False),
    (21, "Owned by client, with ongoing housing subsidy", "Permanent", "Successful Exit", True),
    (3, "Permanent housing for formerly homeless persons (such as: CoC project; or HUD legacy programs; or HOPWA PH)",
     "Permanent", "Successful Exit", True),
    (10, "Rental by client, no ongoing housing subsidy", "Permanent", "Successful Exit", False),
    (28, "Rental by client, with GPD TIP housing subsidy", "Permanent", "Successful Exit", True),
    (20, "Rental by client, with other ongoing housing subsidy",
     "Permanent", "Successful Exit", True),
    (19, "Rental by client, with VASH housing subsidy", "Permanent", "Successful Exit", True),
    (22, "Staying or living with family, permanent tenure", "Permanent", "Successful Exit", False),
    (23, "Staying or living with friends, permanent tenure", "Permanent", "Successful Exit", False),
]

# Disability type codes.
DISABILITY_TYPES = {
    5: "Physical",
    6: "Developmental",
    7: "ChronicHealth",
    8: "HIVAIDS",
    9: "MentalHealth",
    10: "SubstanceAbuse",
}

# Project type codes.
PROJECT_TYPES = {
    1: "Emergency Shelter",
    2: "Transitional Housing",
    3: "PH - Permanent Supportive Housing (disability required for entry)",
    4: "Street Outreach",
    5: "Legacy HPRP",
    6: "Services Only",
    7: "Other Programs",
    8: "Safe Haven",
    9: "PH - Housing Only",
    10: "PH - Housing with Services (no disability required for entry)",
    11: "Day Shelter",
    12: "Homelessness Prevention",
    13: "PH - Rapid Re-Housing",
    14: "Coordinated Assessment",
}
