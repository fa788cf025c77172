"""Other names of common subjects, as library catalogues refer from them: a default for lists of subjects.

Any other list comes with a table of its own (``alias``, ``term``), see ``canonical.map_entries``.
"""

#: Subject -> names referred from (fixed values), in comparable form. A subject that a list does not hold plays no part.
SEE_FROM = {
    "arctic exploration": "polar exploration",
    "aviation": "aeronautics; flying",
    "ballooning": "hot air ballooning",
    "beekeeping": "apiculture; bee culture; keeping bees",
    "bicycle touring": "cycling tours",
    "bookbinding": "binding of books",
    "brewing": "beer making",
    "butterflies": "lepidoptera",
    "cartography": "map making; mapmaking",
    "child rearing": "bringing up children; parenting",
    "cinematography": "motion picture photography",
    "city planning": "town planning; urban planning",
    "clocks and watches": "horology",
    "coins": "numismatics; coin collecting",
    "comparative religion": "religions comparative",
    "cooking": "cookery; cookbooks; recipes",
    "cryptography": "ciphers; secret codes",
    "detective and mystery stories": "whodunits; murder mysteries; crime and detection; detective fiction",
    "education of women": "womens education; female education",
    "entomology": "study of insects; insect study",
    "epidemics": "plagues; pandemics",
    "epistolary fiction": "novels in letters",
    "etiquette": "good manners",
    "fairy tales": "fairytales",
    "fashion design": "dress design",
    "fishing": "angling",
    "folk songs": "traditional songs",
    "folk tales": "folktales",
    "fossils": "paleontology",
    "gardening": "gartenbau; jardinage",
    "genealogy": "family trees; ancestry research; family history",
    "ghost stories": "tales of ghosts; haunted house tales",
    "heraldry": "coats of arms",
    "horsemanship": "equitation; horse riding",
    "labor unions": "trade unions",
    "lexicography": "dictionary making",
    "libraries": "bibliotheques; bibliotheken",
    "lighthouses": "light houses",
    "magic tricks": "conjuring",
    "medicinal plants": "herbal remedies; healing herbs",
    "meteorology": "weather science",
    "midwifery": "midwives and birth attendance",
    "monasticism": "monastic life",
    "mountaineering": "alpinism; mountain climbing",
    "mushrooms": "mycology; fungi edible; edible mushrooms",
    "natural history": "nature study",
    "nursery rhymes": "mother goose rhymes",
    "oceanography": "ocean science",
    "ornithology": "study of birds; bird study",
    "orphans": "orphaned children",
    "photography": "photos and photographers",
    "pirates": "buccaneers",
    "political economy": "economics",
    "postage stamps": "stamp collecting; philately; postal stamps",
    "pottery": "ceramics",
    "printing industry": "printing trade",
    "probabilities": "probability theory",
    "public health": "community health",
    "puppet theater": "marionettes; puppetry",
    "railroad engineering": "railway engineering",
    "railroad travel": "train travel; railway journeys",
    "rain forests": "rainforests; tropical rain forests",
    "robots": "automata; androids; robotics",
    "science fiction": "sf; sci fi; scifi novels; science fiction romances",
    "sea stories": "nautical fiction; maritime fiction",
    "shipbuilding": "ship construction; naval shipbuilding yards",
    "space travel": "spaceflight; interplanetary voyages",
    "spy stories": "secret agent novels; espionage fiction",
    "suffrage": "voting rights",
    "surveying": "land surveying",
    "textile design": "fabric design",
    "translating and interpreting": "translation and interpretation",
    "universities and colleges": "higher education",
    "utopias": "ideal states",
    "veterinary medicine": "veterinary science",
    "violin making": "violinmaking",
    "watercolor painting": "aquarelle painting",
    "weaving": "handweaving",
    "whaling": "whale fishing; whale hunting",
    "wine making": "viniculture; winemaking",
    "wit and humor": "comic writing; humour",
    "wood engraving": "xylography",
}
ALIASES = [(alias, term) for term, names in SEE_FROM.items() for alias in names.split("; ")]
