"""Word lists for generated personal data (own lists; the values only need to look plausible).

Fixed values: the lists below, in this order. Changing them changes every
masked value, so they are versioned with the package.
"""

FEMALE_FIRST_NAMES = (
    "Olivia", "Charlotte", "Amelia", "Isla", "Mia", "Ava", "Grace", "Chloe", "Willow", "Matilda",
    "Ella", "Sophie", "Ruby", "Zoe", "Lily", "Harper", "Evie", "Sienna", "Ivy", "Hannah",
    "Emily", "Lucy", "Georgia", "Jessica", "Sarah", "Emma", "Abigail", "Madison", "Alice", "Scarlett",
    "Audrey", "Holly", "Poppy", "Eleanor", "Stella", "Ruth", "Margaret", "Helen", "Joan", "Diane",
)

MALE_FIRST_NAMES = (
    "Oliver", "Noah", "Jack", "William", "Leo", "Lucas", "Thomas", "Henry", "Charlie", "James",
    "Hudson", "Ethan", "Mason", "Harrison", "Archie", "Lachlan", "Samuel", "Cooper", "Liam", "Max",
    "Oscar", "Isaac", "Hunter", "Riley", "Patrick", "Daniel", "Benjamin", "Joshua", "Ryan", "Angus",
    "Hamish", "Fraser", "Callum", "Toby", "Felix", "Arthur", "George", "Frederick", "Douglas", "Kevin",
)

LAST_NAMES = (
    "Smith", "Jones", "Williams", "Brown", "Wilson", "Taylor", "Johnson", "White", "Martin", "Anderson",
    "Thompson", "Nguyen", "Thomas", "Walker", "Harris", "Lee", "Ryan", "Robinson", "Kelly", "King",
    "Davis", "Wright", "Evans", "Roberts", "Green", "Hall", "Wood", "Jackson", "Clarke", "Patel",
    "Khan", "Lewis", "James", "Phillips", "Mitchell", "Campbell", "Young", "Allen", "Scott", "Baker",
    "Cooper", "Morris", "Murphy", "Graham", "Hughes", "Edwards", "Stewart", "Turner", "Collins", "Murray",
)

STREET_NAMES = (
    "Acacia", "Banksia", "Bottlebrush", "Wattle", "Jacaranda", "Ironbark", "Blackwood", "Bluegum",
    "Coral", "Harbour", "Beach", "Ocean", "River", "Creek", "Ridge", "Valley", "Hill", "Park",
    "Station", "Church", "Mill", "Market", "Bridge", "School", "George", "Victoria", "Albert",
    "Elizabeth", "King", "Queen", "Prince", "Railway", "Short", "Long", "High", "Main", "Forest",
    "Garden", "Spring", "Lake",
)

STREET_SUFFIXES = (
    "Street", "Road", "Avenue", "Drive", "Court", "Place", "Crescent", "Lane", "Parade", "Close",
    "Way", "Terrace", "Boulevard", "Highway", "Grove", "Circuit", "Esplanade", "Rise", "Square", "Walk",
)

CITIES = (
    "Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide", "Hobart", "Darwin", "Canberra",
    "Newcastle", "Wollongong", "Geelong", "Townsville", "Cairns", "Toowoomba", "Ballarat", "Bendigo",
    "Launceston", "Mackay", "Rockhampton", "Bunbury", "Bundaberg", "Wagga Wagga", "Mildura", "Shepparton",
    "Gladstone", "Tamworth", "Orange", "Dubbo", "Geraldton", "Albany", "Kalgoorlie", "Mount Gambier",
    "Lismore", "Bathurst", "Warrnambool", "Devonport", "Burnie", "Alice Springs", "Armidale", "Goulburn",
)

# Australian states and territories.
STATES = (
    "New South Wales", "Victoria", "Queensland", "South Australia", "Western Australia",
    "Tasmania", "Northern Territory", "Australian Capital Territory",
)

EMAIL_DOMAINS = (
    "example.com", "example.net", "example.org", "mail.example.com", "post.example.net",
)

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
