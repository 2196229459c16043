"""Small fixed dimensions: cities, populations, activities.

These are bounded, literal tables (tens of rows), so they are the only
inputs this library broadcasts unconditionally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source data for identical results)
# ---------------------------------------------------------------------------

# (name, state, lat, lon)
CITIES = [
    ("New York City", "NY", 40.7128, -74.0060),
    ("Buffalo", "NY", 42.8864, -78.8784),
    ("Rochester", "NY", 43.1566, -77.6088),
    ("Albany", "NY", 42.6526, -73.7562),
    ("Yonkers", "NY", 40.9312, -73.8988),
    ("Syracuse", "NY", 43.0481, -76.1474),
    ("White Plains", "NY", 41.0340, -73.7629),
    ("Newark", "NJ", 40.7357, -74.1724),
    ("Jersey City", "NJ", 40.7178, -74.0431),
    ("Paterson", "NJ", 40.9168, -74.1718),
    ("Elizabeth", "NJ", 40.6640, -74.2107),
    ("Trenton", "NJ", 40.2170, -74.7429),
    ("Edison", "NJ", 40.5187, -74.4121),
    ("Bridgeport", "CT", 41.1865, -73.1952),
    ("New Haven", "CT", 41.3083, -72.9279),
    ("Stamford", "CT", 41.0534, -73.5387),
    ("Hartford", "CT", 41.7658, -72.6851),
    ("Waterbury", "CT", 41.5582, -73.0515),
    ("Norwalk", "CT", 41.1177, -73.4082),
]

# Inhabitants of each city.
POPULATIONS = [
    ("New York City", 8336817),
    ("Buffalo", 278349),
    ("Rochester", 211328),
    ("Yonkers", 211569),
    ("Syracuse", 148620),
    ("Albany", 99224),
    ("White Plains", 58109),
    ("Newark", 311549),
    ("Jersey City", 292449),
    ("Paterson", 159732),
    ("Elizabeth", 137298),
    ("Edison", 107588),
    ("Trenton", 90871),
    ("Bridgeport", 148654),
    ("New Haven", 130250),
    ("Stamford", 135470),
    ("Hartford", 121054),
    ("Waterbury", 114403),
    ("Norwalk", 91184),
]
DEFAULT_POPULATION = 100000
POP_MIN = 58109      # smallest listed city
POP_MAX = 8336817    # largest listed city

ALL_MONTHS = list(range(1, 13))
APR_OCT = [4, 5, 6, 7, 8, 9, 10]

# city -> ordered list of (name, outdoor, months, tip)
ACTIVITIES = {
    "New York City": [
        ("Central Park", True, APR_OCT, "stroll, bike, or picnic"),
        ("Broadway show", False, ALL_MONTHS, "world-class theater any night"),
        ("MoMA or The Met", False, ALL_MONTHS, "world-class art collections"),
        ("Brooklyn Bridge walk", True, [3, 4, 5, 6, 7, 8, 9, 10, 11], "iconic skyline views"),
        ("Staten Island Ferry", True, ALL_MONTHS, "free Statue of Liberty views"),
        ("ice skating at Bryant Park", True, [12, 1, 2], "free admission rink"),
    ],
    "Buffalo": [
        ("Niagara Falls", True, [5, 6, 7, 8, 9, 10], "one of the great natural wonders"),
        ("Canalside waterfront", True, [5, 6, 7, 8, 9], "concerts, kayaking, and food"),
        ("Albright-Knox Art Gallery", False, ALL_MONTHS, "world-class modern art"),
        ("Delaware Park", True, APR_OCT, "Olmsted-designed park great for walks"),
        ("Buffalo wing trail", False, ALL_MONTHS, "where it all started — Anchor Bar and beyond"),
    ],
    "Rochester": [
        ("George Eastman Museum", False, ALL_MONTHS, "photography and cinema history"),
        ("Lilac Festival at Highland Park", True, [5], "world's largest lilac collection blooms in May"),
        ("High Falls gorge", True, APR_OCT, "scenic urban waterfall"),
        ("Strong National Museum of Play", False, ALL_MONTHS, "fun for all ages"),
    ],
    "Albany": [
        ("New York State Capitol tour", False, ALL_MONTHS, "stunning Romanesque architecture"),
        ("Hudson River cruise", True, [5, 6, 7, 8, 9, 10], "scenic river views heading south"),
        ("Washington Park", True, APR_OCT, "tulip festival in May"),
        ("Albany Institute of History & Art", False, ALL_MONTHS, "Hudson River School paintings"),
    ],
    "Yonkers": [
        ("Untermyer Park & Gardens", True, APR_OCT, "stunning Hudson River overlooks and formal gardens"),
        ("Hudson River Museum", False, ALL_MONTHS, "art and science on the riverfront"),
        ("Yonkers waterfront", True, [4, 5, 6, 7, 8, 9], "revitalized pier with great NYC skyline views"),
    ],
    "Syracuse": [
        ("Erie Canal Museum", False, ALL_MONTHS, "history of the canal that built New York"),
        ("Onondaga Lake Park trail", True, APR_OCT, "waterfront walking and biking"),
        ("Destiny USA", False, ALL_MONTHS, "one of the largest malls in the US"),
        ("New York State Fair", True, [8], "massive annual fair in late August"),
    ],
    "White Plains": [
        ("Kensico Dam Plaza", True, APR_OCT, "concerts, food trucks, and open lawns"),
        ("Westchester County Center", False, ALL_MONTHS, "events, shows, and exhibitions year-round"),
        ("The Westchester mall", False, ALL_MONTHS, "premium shopping close to the city"),
    ],
    "Newark": [
        ("Newark Museum of Art", False, ALL_MONTHS, "NJ's largest museum — free on Sundays"),
        ("Branch Brook Park cherry blossoms", True, [4], "more cherry trees than Washington D.C."),
        ("Prudential Center events", False, ALL_MONTHS, "Devils hockey, concerts, and shows"),
        ("Ironbound district dining", False, ALL_MONTHS,
         "Portuguese and Spanish restaurants renowned across the region"),
    ],
    "Jersey City": [
        ("Liberty State Park", True, ALL_MONTHS, "best view of the Statue of Liberty and NYC skyline"),
        ("Liberty Science Center", False, ALL_MONTHS, "hands-on science museum great for all ages"),
        ("Mana Contemporary", False, ALL_MONTHS, "massive contemporary art complex"),
        ("Grove Street food scene", True, APR_OCT, "vibrant outdoor dining and cafes"),
    ],
    "Paterson": [
        ("Great Falls National Historical Park", True, ALL_MONTHS,
         "one of the largest waterfalls in the US — stunning year-round"),
        ("Paterson Museum", False, ALL_MONTHS, "industrial and cultural history of the Silk City"),
        ("Lambert Castle", True, APR_OCT, "historic castle with Passaic Valley views"),
    ],
    "Elizabeth": [
        ("Warinanco Park", True, APR_OCT, "boating, skating, and open green space"),
        ("Staten Island Ferry gateway", False, ALL_MONTHS, "easy access to NYC via ferry"),
        ("Jersey Gardens outlet mall", False, ALL_MONTHS, "NJ's largest outlet mall — tax-free shopping"),
    ],
    "Trenton": [
        ("New Jersey State Capitol", False, ALL_MONTHS, "free tours of the historic capitol building"),
        ("Grounds for Sculpture", True, APR_OCT, "42-acre sculpture park — one of NJ's gems"),
        ("Trenton Battle Monument", True, APR_OCT, "key Revolutionary War site on the Delaware"),
    ],
    "Edison": [
        ("Thomas Edison Center at Menlo Park", False, ALL_MONTHS,
         "where the phonograph and lightbulb were invented"),
        ("Johnson Park", True, APR_OCT, "riverside park with picnic areas and trails"),
        ("Edison's diverse food scene", False, ALL_MONTHS,
         "acclaimed Indian and Korean restaurants along Oak Tree Rd"),
    ],
    "Bridgeport": [
        ("Beardsley Zoo", True, ALL_MONTHS, "Connecticut's only zoo — open year-round"),
        ("Seaside Park", True, [5, 6, 7, 8, 9], "Olmsted-designed beach park on Long Island Sound"),
        ("Discovery Museum & Planetarium", False, ALL_MONTHS, "hands-on science exhibits and stargazing shows"),
    ],
    "New Haven": [
        ("Yale University Art Gallery", False, ALL_MONTHS, "free world-class art museum open to the public"),
        ("Peabody Museum of Natural History", False, ALL_MONTHS,
         "legendary dinosaur hall and natural history collections"),
        ("Frank Pepe's or Sally's Apizza", False, ALL_MONTHS,
         "legendary New Haven coal-fired pizza — a pilgrimage for food lovers"),
        ("East Rock Park", True, APR_OCT, "stunning panoramic views from the traprock ridge"),
        ("Long Island Sound beaches", True, [6, 7, 8], "Lighthouse Point and Savin Rock in summer"),
    ],
    "Stamford": [
        ("Stamford Museum & Nature Center", True, ALL_MONTHS, "farm animals, trails, and observatory on 118 acres"),
        ("Cove Island Park", True, [5, 6, 7, 8, 9], "beach, kayaking, and bird watching on the Sound"),
        ("Downtown SoNo arts & dining", True, APR_OCT, "vibrant restaurant and gallery scene"),
    ],
    "Hartford": [
        ("Mark Twain House & Museum", False, ALL_MONTHS,
         "tour the Victorian home where Twain wrote his greatest works"),
        ("Wadsworth Atheneum", False, ALL_MONTHS, "oldest public art museum in the US"),
        ("Bushnell Park", True, APR_OCT, "America's oldest publicly funded park — free carousel"),
        ("Hartford Yard Goats game", True, [4, 5, 6, 7, 8, 9], "Double-A baseball at Dunkin' Donuts Park"),
    ],
    "Waterbury": [
        ("Mattatuck Museum", False, ALL_MONTHS, "Connecticut art and history spanning 300 years"),
        ("Lake Quassapaug", True, [6, 7, 8], "swimming, paddleboats, and Quassy Amusement Park"),
        ("Imagine Nation museum", False, ALL_MONTHS, "interactive children's museum"),
    ],
    "Norwalk": [
        ("Maritime Aquarium", False, ALL_MONTHS, "sharks, seals, and Long Island Sound marine life"),
        ("Stepping Stones Museum", False, ALL_MONTHS, "award-winning children's museum"),
        ("SoNo arts & dining district", True, APR_OCT, "galleries, restaurants, and rooftop bars"),
        ("Oyster Festival", True, [9], "huge annual September waterfront festival"),
    ],
}

# ---------------------------------------------------------------------------


def cities_df(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CITIES, "name string, state string, lat double, lon double")
    return df.withColumn(
        "slug",
        F.concat_ws("_", F.lower(F.regexp_replace("name", r"\s+", "_")), F.lower("state")),
    )


def populations_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POPULATIONS, "city string, population bigint")


def activities_df(spark: SparkSession) -> DataFrame:
    rows = [
        (city, i, name, outdoor, months, tip)
        for city, acts in ACTIVITIES.items()
        for i, (name, outdoor, months, tip) in enumerate(acts)
    ]
    return spark.createDataFrame(
        rows,
        "city string, ord int, name string, outdoor boolean, months array<int>, tip string",
    )
