"""Default reference data.

Fixed values: the built-in merchant catalog (category, subcategory, pattern,
priority), the placeholder pay rate and the calendar bounds.  Builds that name
their own catalog or pay-rate file do not use them.
"""

MERCHANT_CATALOG = [
    ("cost-of-living", "take out", r"^.*(eggsupgrill|wendy|raising canes|primohoagies|kanji sushi|rubys bagels|mcdonald|cook out|mi tierra|subway|vivachicken|el patron|eats|culvers|firehouse subs|wingstop|china city|domino|five guys|chick.?fil|kairos|cracker barrel|bennymazzetto|zaxby|doordash|dd store|taco bell|smashley|naan at nexton|rise and shine).*$", 10),
    ("going-out", "restaurants", r"^.*(twisted laurel|rita s |waffle house|silas restaurant|baddaddysburgerbar|bad ?daddy|lowcountry public|home team bbq|cielo mexican|jnn|smoulder|ymap|katsubo).*$", 10),
    ("going-out", "bars", r"^.*(kickin chick|kerryman|agave cantina|pinky & clydes|leye|pack s tavern|new belgium|steel city|rusty bull|o leary|snickers bar|kingstide|godwin).*$", 10),
    ("vice", "alcohol", r"^.*(bottles|atlantic spirits|corner liqour|abc stor|harleyville liquor|palmetto wine).*$", 10),
    ("vice", "sweets", r"^.*(swank desserts|insomnia).*$", 10),
    ("vice", "kratom", r"^.*(ladson vape).*$", 10),
    ("vice", "cannabis", r"^.*(blncd naturals).*$", 10),
    ("entertainment", "video games", r"^.*(microsoft|steam|nintendo|redmond|xbox).*$", 10),
    ("entertainment", "programming", r"^.*(amazon web service|aws|link\.com).*$", 10),
    ("entertainment", "movie theatre", r"^.*(northwoods stadium).*$", 10),
    ("discretional", "online shopping", r"^.*(amazon mktpl|amazon reta|amzn).*$", 10),
    ("discretional", "department store", r"^.*(target|best buy|wm supercenter|wal.?mart).*$", 10),
    ("discretional", "cosmetics", r"^.*(ulta|diesel barbershop|sq summerville na summervill).*$", 10),
    ("discretional", "snacks & beverages", r"^.*(lodi coffee|starbucks|dutch bros|hudsonnews|el cafecito).*$", 10),
    ("discretional", "drinks & snacks", r"^.*(ctlp).*$", 10),
    ("discretional", "holiday", r"^.*(tnt fireworks|fireworks).*$", 10),
    ("discretional", "events", r"^.*(theknot|somethingborrowedb).*$", 10),
    ("subscription", "streaming", r"^.*(netflix).*$", 10),
    ("subscription", "content creators", r"^.*(patreon).*$", 10),
    ("subscription", "gym", r"^.*(bold fitness).*$", 10),
    ("home-goods", "clothing", r"^.*(kohls|adidas|old navy|h&m).*$", 10),
    ("home-goods", "home hardware", r"^.*(lowe s|home depot).*$", 10),
    ("home-goods", "amenities", r"^.*(bath and body works).*$", 10),
    ("home-goods", "coffee", r"^.*(nespresso).*$", 10),
    ("cost-of-living", "grocery", r"^.*(212meals|piggly wiggly|harris ?teeter|aldi|costco|publix|ingles).*$", 10),
    ("cost-of-living", "gas", r"^.*(enmarket|spinx|sunoco|scotchman|shell oil|shell service).*$", 10),
    ("cost-of-living", "healthcare", r"^.*(cvs).*$", 10),
    ("cost-of-living", "home maintenance", r"^.*(core pest solu).*$", 10),
    ("cost-of-living", "laundry", r"^.*(dropps).*$", 10),
    ("cost-of-living", "utility electricity", r"^.*(dominion energy).*$", 10),
    ("cost-of-living", "utility internet", r"^.*(comcast|xfinity).*$", 10),
    ("cost-of-living", "utility phone", r"^.*(tmobile).*$", 10),
    ("cost-of-living", "utility water", r"^.*(allpaid|town of li).*$", 10),
    ("pet-care", "pet food", r"^.*(petsmart).*$", 10),
    ("pet-care", "grooming", r"^.*(furryland).*$", 10),
    ("pet-care", "emergency care", r"^.*(bluepearl).*$", 10),
    ("travel", "airfare", r"^.*(american ai|united).*$", 10),
    ("travel", "attractions", r"^.*(cypress gardens).*$", 10),
    ("travel", "hotel", r"^.*(hyatt place|loft of ashevil).*$", 10),
    ("travel", "boutique/gift shop", r"^.*(willows dream).*$", 10),
    ("travel", "rideshare", r"^.*(uber tech|ubr pending|uber +\*trip).*$", 10),
    ("debt", "car payment", r"^.*(wells fargo auto).*$", 10),
    ("debt", "credit card interest", r"^.*(interest charge).*$", 10),
    ("debt", "credit card payment", r"^.*(transfer to credit card).*$", 5),
    ("debt", "mortgage", r"^.*(transfer to mortgage).*$", 5),
    ("fees", "HOA", r"^.*(assn dues|dunmeyer hill).*$", 10),
    ("fees", "atm", r"^.*(atm withdrawal|atm fee).*$", 10),
    ("fees", "taxes", r"^.*(federal tax|fed tax).*$", 10),
    ("fees", "parking", r"^.*(city of asheville).*$", 10),
    ("fees", "international", r"^.*(international transaction fee|intl transaction).*$", 1),
    ("payments", "peer to peer", r"^.*(zelle|venmo).*$", 10),
    ("payments", "dividend", r"^.*(dividend).*$", 10),
    ("payments", "online payment", r"^.*(nfo payment).*$", 10),
    ("payments", "rewards", r"^.*(reward redemption|atm rebate).*$", 10),
    ("payments", "refunds", r"^.*(pos adjustment).*$", 1),
    ("transfers", "other account", r"^.*(transfer to|transfer from).*$", 10),
]

PLACEHOLDER_PAYRATE = (
    "PLACEHOLDER - REAL PAYRATE IS READ FROM S3",
    "000 Placeholder Way, Example, XX 00000",
    "0.00",
    "1900-01-01",
    "9999-12-31",
)

CALENDAR_START = "2026-01-01"
CALENDAR_END = "2099-12-31"  # exclusive
