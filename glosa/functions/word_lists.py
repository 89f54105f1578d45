"""Word lists shipped with the package."""

# --- Fixed values: word lists ------------------------------------------------
BOOSTERS = """
absolutely
amazingly
awfully
completely
considerably
decidedly
deeply
enormously
entirely
especially
exceptionally
extremely
fabulously
fully
greatly
highly
hugely
incredibly
intensely
majorly
more
most
particularly
purely
quite
really
remarkably
so
substantially
thoroughly
totally
tremendously
uber
unbelievably
unusually
utterly
very
indeed
perfectly
profoundly
superior
surely
truly
undoubtedly
unequivocally
unquestionably
vastly
vitally
well-known
""".strip().splitlines()

MITIGATORS = """
almost
barely
hardly
kind of
kinda
sort of
sorta
somewhat
slightly
marginally
little
partly
occasionally
scarcely
less
""".strip().splitlines()

NEGATIONS = """
aint
arent
cannot
cant
couldnt
darent
didnt
doesnt
ain't
aren't
can't
couldn't
daren't
didn't
doesn't
dont
hadnt
hasnt
havent
isnt
mightnt
mustnt
neither
don't
hadn't
hasn't
haven't
isn't
mightn't
mustn't
neednt
needn't
never
none
nope
nor
not
nothing
nowhere
oughtnt
shant
shouldnt
uhuh
wasnt
werent
oughtn't
shan't
shouldn't
uh-uh
wasn't
weren't
without
wont
wouldnt
won't
wouldn't
rarely
seldom
despite
""".strip().splitlines()

CERTAINTY_MARKERS = """
actually
certainly
clearly
definitely
evidently
obviously
undeniably
unmistakably
plainly
indeed
truly
we know
in fact
of course
""".strip().splitlines()

HEDGE_WORDS = """
suggest
believe
appear
indicate
assume
seem
consider
doubt
estimate
expect
feel
guess
imagine
speculate
suppose
think
understand
imply
presume
suspect
postulate
reckon
infer
hope
rather
slightly
barely
strictly
presumably
fairly
theoretically
basically
relatively
possibly
preferably
slenderly
scantily
decidedly
arguably
seemingly
occasionally
partially
partly
practically
roughly
virtually
allegedly
presumable
possible
probably
likely
apparent
probable
improbable
unlikely
rarely
improbably
unclearly
unsure
sure
chance
unclear
may
might
maybe
shall
should
can
could
would
ought
usually
approximately
generally
frequently
normally
""".strip().splitlines()

PROPOSITIONAL_HEDGES = """
a bit
a bunch
a couple
a few
a little
a whole bunch
about
allegedly
among others
and all that
and so forth
and so on
and suchlike
apparently
approximately
around
at least
basic
basically
completely
et cetera
etc
fair
fairly
for the most part
frequently
general
generally
in a way
in part
in some ways
kind of
kinda
largely
like
mainly
more or less
most
mostly
much
occasionally
often
partial
partially
partly
possible
practically
pretty
pretty much
probable
rarely
rather
really
relatively
rough
roughly
seldom
several
something or other
sort of
to a certain extent
to some extent
totally
usually
virtually
""".strip().splitlines()

RELATIONAL_HEDGES = """
according to
appear
arguably
assume
believe
consider
could
doubt
estimate
expect
feel
find
guess
hear
i mean
i would say
imagine
impression
in my mind
in my opinion
in my understanding
in my view
know
likely
look like
looks like
may
maybe
might
my thinking
my understanding
necessarily
perhaps
possibly
presumably
probably
read
say
seem
seemingly
should
sound like
sounds like
speculate
suggest
suppose
sure
tend
think
understand
unlikely
unsure
""".strip().splitlines()

FIRST_PERSON_PHRASES = [
    "i think", "i believe", "i feel", "in my opinion", "personally", "i would say", "i suppose",
]

EPISTEMIC_MARKERS = [
    "probably", "possibly", "perhaps", "maybe", "supposedly", "presumably", "conceivably",
]

APPEARANCE_PHRASES = [
    "it seems", "it appears", "apparently", "seemingly", "it looks like", "seems like",
]

SUBJECTIVITY_MARKERS = [
    "i_think", "i_believe", "i_feel", "in_my_opinion", "personally", "it_seems", "it_appears",
    "probably", "possibly", "perhaps", "maybe", "supposedly", "arguably", "apparently",
    "presumably",
]
# -----------------------------------------------------------------------------

# Small lists of our own; pass larger ones to ``Lexicon`` or load them from files.
POSITIVE_WORDS = """
amazing awesome beautiful best brilliant charming clean clever delightful easy elegant engaging
enjoy enjoyable enjoyed excellent exciting fantastic fast favorite fine fresh fun funny good great
happy impressive interesting like love loved lovely masterpiece neat nice perfect pleasant recommend
rewarding simple smart smooth solid strong superb tense thematic tight top unique well wonderful
worth
""".split()

NEGATIVE_WORDS = """
annoying awful bad bland boring broken chaotic cheap clunky complicated confusing dated
disappointing dislike dry dull fiddly flawed frustrating hate hated horrible lame long mediocre mess
messy poor pointless random repetitive sad shallow slow stupid tedious terrible tired tiring trauma
trivial ugly unbalanced unfair useless waste weak worse worst wrong
""".split()

DISCOURSE_MARKERS = """
although anyway besides but conversely furthermore however moreover nevertheless nonetheless
otherwise regardless still then therefore though thus whereas while yet
""".split()

DOMAIN_TERMS = {
    "components": "art artwork board box card cards component components dice figures meeples miniatures pieces quality tiles tokens".split(),
    "gameplay": "bluffing combos cooperative decisions drafting interaction luck mechanics strategy tactics theme turn turns".split(),
    "experience": "downtime family game games length party player players playtime replayability rules setup".split(),
}

# Valence of single words on a -4..4 scale, our own values.
VALENCE = {
    "amazing": 2.8, "awesome": 3.1, "bad": -2.5, "best": 3.2, "boring": -1.3, "brilliant": 2.8,
    "broken": -2.1, "confusing": -0.9, "disappointing": -2.2, "dull": -1.7, "enjoy": 2.2,
    "excellent": 2.7, "fantastic": 2.6, "favorite": 2.0, "frustrating": -1.9, "fun": 2.3,
    "good": 1.9, "great": 3.1, "hate": -2.7, "horrible": -2.5, "like": 1.5, "love": 3.2,
    "mess": -1.5, "nice": 1.8, "perfect": 2.7, "poor": -2.1, "recommend": 1.5, "sad": -2.1,
    "terrible": -2.1, "ugly": -2.3, "waste": -1.8, "weak": -1.9, "wonderful": 2.7, "worst": -3.1,
}
