"""Fixed values that the oracles expect, stated apart from the library's own so that an error in either shows."""

# Port codes, in the order in which combined texts are searched.
PORT_CODES = {
    "NLRTM": "ROTTERDAM", "NLAMS": "AMSTERDAM", "NLVLI": "VLISSINGEN", "BEANR": "ANTWERP", "GBLGP": "LONDON",
    "GBHRW": "HARWICH", "DEHAM": "HAMBURG", "DECUX": "CUXHAVEN", "DKSKA": "SKAGEN", "DEBRV": "BREMERHAVEN",
    "BEZEE": "ZEEBRUGGE", "NLTNZ": "TERNEUZEN", "ANT": "ANTWERP", "CUX": "CUXHAVEN",
}

# Codes and corrections of the exploratory profile, then the corrections of the reports.
PROFILE_CODES = {"NLRTM": "ROTTERDAM", "NLAMS": "AMSTERDAM", "NLVLI": "VLISSINGEN", "BEANR": "ANTWERP"}
PROFILE_CORRECTIONS = [
    ("^ROT+EDAM$", "ROTTERDAM"), ("^NLROTTERDAM$", "ROTTERDAM"), ("^ROTTERDAM.*$", "ROTTERDAM"), ("^AMS$", "AMSTERDAM"),
    ("^AMSTERD[A-Z]*$", "AMSTERDAM"), ("^VLISS?INGEN$", "VLISSINGEN"), ("^LIVERPOOLTUGOPS$", "LIVERPOOL"),
    ("^HARBOURTOWAGE$", "HARBOURTUG"), ("^FISHINGGROUNDS?$", "FISHING"), ("^0OSTENDE$", "OOSTENDE"), ("^0$", ""),
]
CORRECTIONS = [
    ("^ROT+EDAM$", "ROTTERDAM"), ("^NLROTTERDAM$", "ROTTERDAM"), ("^ROTTERDAM.*$", "ROTTERDAM"), ("^AMS$", "AMSTERDAM"),
    ("^AMSTERD[A-Z]*$", "AMSTERDAM"), ("^VLISS?INGEN$", "VLISSINGEN"), ("^LIVERPOOLTUGOPS$", "LIVERPOOL"),
    ("^HARBOURTOWAGE$", "HARBOURTUG"), ("^FISHINGGROUNDS?$", "FISHING"), ("^FISHGORUND$", "FISHING"), ("^0OSTENDE$", "OOSTENDE"),
    ("^0$", ""), ("^GBLGP.*$", "LONDON"), ("^GBHRW.*$", "HARWICH"), ("^DEHAM.*$", "HAMBURG"), ("^BERGENMOBERGEN$", "BERGEN"),
    ("^ANTWERPEN$", "ANTWERP"), ("^ROTTHULLROTT$", "ROTTERDAM"), ("^ROTTHULL$", "ROTTERDAM"), ("^HULLROTT$", "HULL"),
]

NAV_STATUSES = [
    "Underway using engine", "At anchor", "Not under command", "Restricted maneuverability", "Constrained by her draught", "Moored", "Aground",
    "Engaged in fishing", "Underway sailing",
    "Reserved for future amendment of navigational status for ships carrying DG, HS or IMO hazard or pollutant category C, HSC",
    "Reserved for future amendment of navigational status for ships carrying DG, HS, MP or IMO hazard or pollutant category A, WIG",
    "Power-driven vessel towing astern", "Power-driven vessel pushing ahead or towing alongside", "Reserved for future use",
    "AIS-SART Active, AIS-MOB, AIS-EPIRB", "Undefined",
]
