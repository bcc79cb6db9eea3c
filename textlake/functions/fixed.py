"""Word lists and formats that results depend on."""

from __future__ import annotations

# English stop words (Spark's default list).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an
the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()

# Dictionary forms of common irregular English words, "form lemma".
LEMMAS = dict(
    pair.split()
    for pair in """
    am be, is be, are be, was be, were be, been be, being be, has have, had have, having have,
    does do, did do, done do, doing do, goes go, went go, gone go, ran run, running run,
    made make, said say, took take, taken take, came come, saw see, seen see, knew know,
    known know, got get, gotten get, gave give, given give, found find, thought think,
    told tell, became become, left leave, felt feel, brought bring, began begin, begun begin,
    kept keep, held hold, wrote write, written write, stood stand, heard hear, meant mean,
    met meet, paid pay, sat sit, spoke speak, spoken speak, led lead, grew grow, grown grow,
    lost lose, fell fall, fallen fall, sent send, built build, understood understand,
    drew draw, drawn draw, broke break, broken break, spent spend, rose rise, risen rise,
    drove drive, driven drive, bought buy, wore wear, worn wear, chose choose, chosen choose,
    ate eat, eaten eat, flew fly, flown fly, slept sleep, won win, taught teach, caught catch,
    better good, best good, worse bad, worst bad, more much, most much, less little,
    children child, men man, women woman, people person, feet foot, teeth tooth, mice mouse,
    geese goose, lives life, wives wife, knives knife, leaves leaf, data datum,
    studies study, studied study, studying study
    """.split(",")
)

# Opinion words of general English and their weights.
OPINION_WORDS = {
    **dict.fromkeys(
        """admire amazing awesome beautiful best better brilliant calm charming clean comfortable delightful easy
        enjoy enjoyed excellent fantastic fast fine friendly fun generous good great happy helpful honest impressive
        kind like love loved lovely nice perfect pleasant pleased polite pretty recommend reliable satisfied smart
        smooth strong success superb thank thanks useful warm well wonderful worth""".split(),
        1.0,
    ),
    **dict.fromkeys(
        """angry annoying awful bad boring broken cheap complain confusing cruel damage damaged dangerous defective
        dirty disappointing disgusting dreadful dull error fail failed failure faulty hate hated horrible hurt
        inferior lazy mess nasty never not painful pathetic poor problem regret rude sad slow stupid terrible
        tired ugly unhappy unpleasant useless waste weak worse worst wrong""".split(),
        -1.0,
    ),
}

# Kinds of entities.
ENTITY_TYPES = ["PRODUCT", "ORG", "GPE", "PERSON"]

# Reserved ids of the first-seen word vocabulary.
PAD_ID, START_ID, END_ID, FIRST_WORD_ID = 0, 1, 2, 3

# Leading special tokens of the byte-pair vocabulary.
BPE_SPECIALS = ["<s>", "<pad>", "</s>", "<unk>", "<mask>"]

# Fixed value: chat training text; the inner indentation belongs to the format.
CHAT_FORMAT = """<|begin_of_text|><|start_header_id|>user<|end_header_id|>
                        {problem}<|eot_id|><|start_header_id|>assistant<|end_header_id|>
                        {answer}<|eot_id|>"""

# Fixed value: question prompt; context and question are filled in.
PROMPT_FORMAT = """Answer the question based only on the following context: {context}
        Question: {question}

        Helpful Answer:"""

# Search result defaults and the sentence for an empty result.
NO_TITLE, NO_URL, NO_CONTENT = "No Title", "", "No content available."
NO_RESULTS = "No results found for the given query."
