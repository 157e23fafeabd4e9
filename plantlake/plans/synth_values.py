"""Fixed values of the synthetic plant. They are data: names, limits and weights
that generated tables must contain."""

# city, state, country, latitude, longitude
CITIES = [
    ("Houston", "TX", "USA", 29.76, -95.37),
    ("Beaumont", "TX", "USA", 30.08, -94.10),
    ("Lake Charles", "LA", "USA", 30.21, -93.22),
    ("Baton Rouge", "LA", "USA", 30.45, -91.15),
    ("New Orleans", "LA", "USA", 29.95, -90.07),
    ("Port Arthur", "TX", "USA", 29.90, -93.93),
    ("Corpus Christi", "TX", "USA", 27.80, -97.40),
    ("Philadelphia", "PA", "USA", 39.95, -75.17),
    ("Los Angeles", "CA", "USA", 34.05, -118.24),
    ("San Francisco", "CA", "USA", 37.77, -122.42),
    ("Chicago", "IL", "USA", 41.88, -87.63),
    ("Detroit", "MI", "USA", 42.33, -83.05),
    ("Rotterdam", "ZH", "NLD", 51.92, 4.48),
    ("Singapore", "SG", "SGP", 1.35, 103.82),
    ("Jamnagar", "GJ", "IND", 22.47, 70.07),
]
OPERATORS = ["PetroCorp", "GlobalRefining", "CoastalEnergy", "TransOil",
             "PacificPetroleum", "AtlanticFuels", "MidwestRefinery", "SunsetOil"]

# type, subtype, design efficiency
UNIT_TYPES = [
    ("Crude Distillation", "Atmospheric", 0.95),
    ("Crude Distillation", "Vacuum", 0.93),
    ("Fluid Catalytic Cracker", "Resid FCC", 0.90),
    ("Hydrocracker", "Mild", 0.92),
    ("Hydrocracker", "Full Conversion", 0.88),
    ("Reformer", "Continuous", 0.91),
    ("Reformer", "Semi-Regenerative", 0.89),
    ("Alkylation", "HF Process", 0.94),
    ("Alkylation", "Sulfuric Acid", 0.93),
    ("Coker", "Delayed", 0.87),
    ("Coker", "Fluid", 0.85),
    ("Hydrotreater", "Naphtha", 0.96),
    ("Hydrotreater", "Diesel", 0.95),
    ("Sulfur Recovery", "Claus", 0.98),
]
UNIT_MAKERS = ["Honeywell UOP", "Axens", "Shell Global", "ExxonMobil",
               "Chevron Lummus", "KBR", "CB&I", "Technip"]
MAINTENANCE_INTERVALS = [90, 180, 365]

# type, unit, min, max, warning low, warning high, critical low, critical high
SENSOR_TYPES = [
    ("Temperature", "Fahrenheit", 0.0, 1200.0, 200.0, 900.0, 100.0, 1000.0),
    ("Temperature", "Celsius", -50.0, 600.0, 50.0, 500.0, 0.0, 550.0),
    ("Pressure", "PSI", 0.0, 5000.0, 50.0, 3000.0, 10.0, 4000.0),
    ("Pressure", "Bar", 0.0, 350.0, 5.0, 200.0, 1.0, 280.0),
    ("Flow Rate", "BPH", 0.0, 50000.0, 1000.0, 40000.0, 500.0, 45000.0),
    ("Flow Rate", "GPM", 0.0, 100000.0, 2000.0, 80000.0, 1000.0, 90000.0),
    ("Level", "Percent", 0.0, 100.0, 10.0, 95.0, 5.0, 98.0),
    ("Level", "Feet", 0.0, 50.0, 5.0, 45.0, 2.0, 48.0),
    ("Vibration", "mm/s", 0.0, 50.0, 0.0, 20.0, 0.0, 35.0),
    ("Vibration", "mils", 0.0, 10.0, 0.0, 5.0, 0.0, 8.0),
    ("pH", "pH", 0.0, 14.0, 4.0, 10.0, 2.0, 12.0),
    ("Density", "API", 0.0, 80.0, 20.0, 50.0, 10.0, 60.0),
    ("Viscosity", "cSt", 0.0, 1000.0, 1.0, 500.0, 0.5, 800.0),
]
SENSOR_MAKERS = ["Emerson", "Honeywell", "Siemens", "ABB", "Yokogawa", "Endress+Hauser"]
READING_INTERVALS = [(5, 0.1), (10, 0.5), (30, 0.3), (60, 0.1)]

# id, name, abbreviation, country, region, gravity, sulfur, class, sweetness, price differential
CRUDE_TYPES = [
    ("CRUDE-001", "West Texas Intermediate", "WTI", "USA", "Permian Basin", 39.6, 0.24, "Light", "Sweet", -3.5),
    ("CRUDE-002", "Brent", "BRENT", "UK", "North Sea", 38.3, 0.37, "Light", "Sweet", 0.0),
    ("CRUDE-003", "Dubai", "DUBAI", "UAE", "Persian Gulf", 31.0, 2.0, "Medium", "Sour", -2.0),
    ("CRUDE-004", "Arab Light", "AL", "SAU", "Ghawar", 33.0, 1.77, "Light", "Sour", -1.5),
    ("CRUDE-005", "Arab Heavy", "AH", "SAU", "Safaniya", 27.0, 2.8, "Heavy", "Sour", -5.0),
    ("CRUDE-006", "Bonny Light", "BONNY", "NGA", "Niger Delta", 33.4, 0.16, "Light", "Sweet", 2.0),
    ("CRUDE-007", "Mars", "MARS", "USA", "Gulf of Mexico", 31.0, 1.93, "Medium", "Sour", -4.0),
    ("CRUDE-008", "Maya", "MAYA", "MEX", "Campeche", 22.0, 3.3, "Heavy", "Sour", -10.0),
    ("CRUDE-009", "Urals", "URALS", "RUS", "Western Siberia", 31.7, 1.35, "Medium", "Sour", -15.0),
    ("CRUDE-010", "Tapis", "TAPIS", "MYS", "Malay Basin", 44.3, 0.04, "Light", "Sweet", 5.0),
    ("CRUDE-011", "Saharan Blend", "SAHARAN", "DZA", "Hassi Messaoud", 45.5, 0.09, "Light", "Sweet", 3.0),
    ("CRUDE-012", "Forcados", "FORCADOS", "NGA", "Niger Delta", 29.6, 0.18, "Light", "Sweet", 1.5),
    ("CRUDE-013", "Ekofisk", "EKO", "NOR", "North Sea", 43.4, 0.17, "Light", "Sweet", 1.0),
    ("CRUDE-014", "Louisiana Light", "LLS", "USA", "Gulf Coast", 36.0, 0.4, "Light", "Sweet", -1.0),
    ("CRUDE-015", "Heavy Louisiana Sweet", "HLS", "USA", "Gulf Coast", 32.5, 0.3, "Medium", "Sweet", -2.5),
]

# id, name, category, grade, density min, density max, sulfur max ppm, typical yield
PRODUCTS = [
    ("PROD-001", "Regular Gasoline", "Gasoline", "87 Octane", 720.0, 775.0, 10, 0.25),
    ("PROD-002", "Premium Gasoline", "Gasoline", "91 Octane", 720.0, 770.0, 10, 0.15),
    ("PROD-003", "Super Premium Gasoline", "Gasoline", "93 Octane", 715.0, 765.0, 10, 0.1),
    ("PROD-004", "Ultra Low Sulfur Diesel", "Diesel", "ULSD", 820.0, 860.0, 15, 0.28),
    ("PROD-005", "Heating Oil", "Distillate", "No. 2", 830.0, 870.0, 500, 0.08),
    ("PROD-006", "Jet Fuel A", "Jet Fuel", "Jet A", 775.0, 840.0, 3000, 0.08),
    ("PROD-007", "Kerosene", "Distillate", "K-1", 780.0, 830.0, 40, 0.03),
    ("PROD-008", "Naphtha", "Feedstock", "Light", 650.0, 720.0, 500, 0.05),
    ("PROD-009", "LPG", "Gas", "Propane/Butane", 500.0, 600.0, 50, 0.04),
    ("PROD-010", "Residual Fuel Oil", "Residual", "No. 6", 950.0, 1010.0, 35000, 0.03),
    ("PROD-011", "Asphalt", "Residual", "Paving Grade", 1010.0, 1060.0, 50000, 0.02),
    ("PROD-012", "Petroleum Coke", "Solid", "Fuel Grade", 1400.0, 1600.0, 80000, 0.04),
    ("PROD-013", "Lubricant Base Oil", "Lubricant", "Group II", 850.0, 890.0, 10, 0.02),
    ("PROD-014", "Sulfur", "Byproduct", "Eleite", 1800.0, 2100.0, 0, 0.015),
]

TANK_TYPES = [("Floating Roof", 0.4), ("Fixed Roof", 0.3), ("Spherical", 0.15), ("Horizontal", 0.15)]
TANK_PRODUCTS = [("Crude Oil", 0.3), ("Gasoline", 0.25), ("Diesel", 0.2), ("Jet Fuel", 0.15), ("Residual", 0.1)]
TANK_CAPACITIES = [(100000, 0.2), (250000, 0.3), (500000, 0.25), (750000, 0.15), (1000000, 0.1)]
TANK_MATERIALS = [("Carbon Steel", 0.8), ("Stainless Steel", 0.2)]

QUALITY_LABELS = [("GOOD", 0.97), ("UNCERTAIN", 0.025), ("BAD", 0.005)]

TRANSPORT_MODES = [("Tanker", 0.5), ("Pipeline", 0.3), ("Barge", 0.15), ("Rail", 0.05)]
PORTS = ["Ras Tanura", "Houston", "Rotterdam", "Singapore", "Fujairah",
         "Corpus Christi", "Louisiana Offshore", "Bonny", "Primorsk"]
SHIPMENT_STATUSES = [("SCHEDULED", 0.05), ("IN_TRANSIT", 0.1), ("DELIVERED", 0.8), ("DELAYED", 0.05)]
VESSELS = ["Pacific Star", "Atlantic Grace", "Gulf Spirit", "Ocean Pride",
           "Coastal Dawn", "Marine King", "Sea Fortune", "Tanker Alpha"]

TEST_TYPES = [("Full Assay", 0.2), ("Spot Check", 0.5), ("Blend Verification", 0.2),
              ("Product Certification", 0.1)]
SAMPLE_SOURCES = [("Crude Shipment", 0.3), ("Tank Sample", 0.4), ("Process Stream", 0.2),
                  ("Product Output", 0.1)]
TEST_STATUSES = [("PASS", 0.85), ("FAIL", 0.05), ("MARGINAL", 0.08), ("PENDING", 0.02)]
TEST_NOTES = ["Within spec", "Minor variance", "Requires retest", "Approved", "See lab report"]

GAUGES = [("Radar Gauge", 0.6), ("Manual Dip", 0.1), ("Float Gauge", 0.15), ("Servo Gauge", 0.15)]
DOWNTIME_MINUTES = [0, 0, 0, 0, 0, 15, 30, 60]
GRADES = [("On-Spec", 0.85), ("Off-Spec", 0.10), ("Premium", 0.05)]
SHIFTS = ["SHIFT-A", "SHIFT-B", "SHIFT-C"]
