"""Suffix rules of the Portuguese stemmer of Orengo & Huyck (2001), as data.

A rule reads: suffix, shortest stem it may leave, replacement (`-` for none), then the words it
does not apply to. Within a step the first rule that applies wins. Other rule sets may be passed
to the stemming functions in the same form.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    suffix: str
    min_stem: int
    replacement: str
    exceptions: tuple[str, ...]


def read_rules(text: str) -> tuple[Rule, ...]:
    parts = (line.split() for line in text.strip().splitlines())
    return tuple(Rule(p[0], int(p[1]), p[2].replace("-", ""), tuple(p[3:])) for p in parts)


# Suffix rules and their exceptions.
PLURAL = read_rules("""
ns 1 m
ões 3 ão
ães 1 ão mãe
ais 1 al cais mais
éis 2 el
eis 2 el
óis 2 ol
is 2 il lápis cais mais crúcis biquínis pois depois dois leis
les 3 l
res 3 r
s 2 - aliás pires lápis cais mais mas menos férias fezes pêsames crúcis gás atrás moisés através convés ês país após ambas ambos messias
""")

FEMININE = read_rules("""
ona 3 ão abandona lona iona cortisona monótona maratona acetona detona carona
ora 3 or
na 4 no carona abandona lona iona cortisona monótona maratona acetona detona guiana campana grana caravana banana paisana
inha 3 inho rainha linha minha
esa 3 ês mesa obesa princesa turquesa ilesa pesa presa
osa 3 oso mucosa prosa
íaca 3 íaco
ica 3 ico dica
ada 2 ado pitada
ida 3 ido vida
ída 3 ído recaída saída dúvida
ima 3 imo vítima
iva 3 ivo saliva oliva
eira 3 eiro beira cadeira frigideira bandeira feira capoeira barreira fronteira besteira poeira
ã 2 ão amanhã arapuã fã divã
""")

AUGMENTATIVE = read_rules("""
díssimo 5 -
abilíssimo 5 -
íssimo 3 -
ésimo 3 -
érrimo 4 -
zinho 2 -
quinho 4 c
uinho 4 -
adinho 3 -
inho 3 - caminho cominho
alhão 4 -
uça 4 -
aço 4 - antebraço
adão 4 -
ázio 3 - topázio
arraz 4 -
arra 3 -
zão 2 - coalizão
ão 3 - camarão chimarrão canção coração embrião grotão glutão ficção fogão feição furacão gamão lampião leão macacão nação órfão orgão patrão portão quinhão rincão tração falcão espião mamão folião cordão aptidão campeão colchão limão leilão melão barão milhão bilhão fusão cristão ilusão capitão estação senão
""")

ADVERB = read_rules("""
mente 4 - experimente
""")

NOUN = read_rules("""
encialista 4 -
alista 5 -
agem 3 - coragem chantagem vantagem carruagem
iamento 4 -
amento 3 - firmamento fundamento departamento
imento 3 -
mento 6 - firmamento elemento complemento instrumento departamento
alizado 4 -
atizado 4 -
tizado 4 - alfabetizado
izado 5 - organizado pulverizado
ativo 4 - pejorativo relativo
tivo 4 - relativo
ivo 4 - passivo possessivo pejorativo positivo
ado 2 - grado
ido 3 - cândido consolido rápido decido tímido duvido marido
ador 3 -
edor 3 -
idor 4 - ouvidor
dor 4 - ouvidor
sor 4 - assessor
atoria 5 -
tor 3 - benfeitor leitor editor pastor produtor promotor consultor
or 2 - motor melhor redor rigor sensor tambor tumor assessor benfeitor pastor terior favor autor
abilidade 5 -
icionista 4 -
cionista 5 -
ionista 5 -
ionar 5 -
ional 4 -
ência 3 -
ância 4 - ambulância
edouro 3 -
queiro 3 c
adeiro 4 - desfiladeiro
eiro 3 - desfiladeiro pioneiro mosteiro
uoso 3 -
oso 3 - precioso
alizaç 5 -
atizaç 5 -
tizaç 5 -
izaç 5 - organizaç
aç 3 - equaç relaç
iç 3 - eleiç
ário 3 - voluntário salário aniversário diário lionário armário
atório 3 -
rio 5 - voluntário salário aniversário diário compulsório lionário próprio stério armário
ério 6 -
ês 4 -
eza 3 -
ez 4 -
esco 4 -
ante 2 - gigante elefante adiante possante instante restaurante
ástico 4 - eclesiástico
alístico 3 -
áutico 4 -
êutico 4 -
tico 3 - político eclesiástico diagnostico prático doméstico diagnóstico idêntico alopático artístico autêntico eclético crítico critico
ico 4 - tico público explico
ividade 5 -
idade 4 - autoridade comunidade
oria 4 - categoria
encial 5 -
ista 4 -
auta 5 -
quice 4 c
ice 4 - cúmplice
íaco 3 -
ente 4 - freqüente alimente acrescente permanente oriente aparente
ense 5 -
inal 3 -
ano 4 -
ável 2 - afável razoável potável vulnerável
ível 3 - possível
vel 5 - possível vulnerável solúvel
bil 3 vel
ura 4 - imatura acupuntura costura
ural 4 -
ual 3 - bissexual virtual visual pontual
ial 3 -
al 4 - afinal animal estatal bissexual desleal fiscal formal pessoal liberal postal virtual visual pontual sideral sucursal
alismo 4 -
ivismo 4 -
ismo 3 - cinismo
""")

VOWEL = read_rules("""
gue 2 g gangue jegue
á 3 -
ê 3 - bebê
a 3 - ásia
e 3 -
o 3 - ão
""")

# Verb endings, longer ones first.
VERB = read_rules("""
aríamo 2 -
eríamo 3 -
iríamo 3 -
ássemo 2 -
êssemo 3 -
íssemo 3 -
aremo 2 -
ariam 2 -
aríei 2 -
assem 2 -
eremo 3 -
eriam 3 -
eríei 3 -
essem 3 -
iremo 3 -
iriam 3 -
iríei 3 -
issem 3 -
áramo 2 -
ássei 2 -
ávamo 2 -
êramo 3 -
êssei 3 -
íramo 3 -
íssei 3 -
ando 2 -
aram 2 -
arde 2 -
arei 2 -
arem 2 -
aria 2 -
armo 2 -
arão 2 -
asse 2 -
aste 2 -
avam 2 - agravam
endo 3 -
eram 3 -
erde 3 -
erei 3 -
erem 3 -
eria 3 -
ermo 3 -
erão 3 -
esse 3 -
este 3 - faroeste agreste
guem 3 -
iava 4 - ampliava
indo 3 -
iona 3 -
iram 3 -
irde 2 -
irei 3 - admirei
irem 3 - adquirem
iria 3 -
irmo 3 -
irão 2 -
isse 3 -
iste 4 -
ondo 3 -
árei 2 -
ávei 2 -
êrei 3 -
íamo 3 -
íram 3 -
írei 3 -
amo 2 -
ara 2 - arara prepara
are 2 - prepare
ará 2 - alvará
ava 2 - agrava
ear 4 - alardear nuclear
emo 2 -
eou 5 -
era 3 - acelera espera
ere 3 - espere
erá 3 -
iam 3 - enfiam ampliam elogiam ensaiam
imo 3 - reprimo intimo íntimo nimo queimo ximo
ira 3 - fronteira sátira
ire 3 - adquire
irá 3 -
omo 3 -
tiz 4 -
uei 3 -
uía 5 -
ído 3 -
íei 3 -
ai 2 -
am 2 -
ar 2 - azar bazar patamar
ei 3 -
em 2 - alem virgem
er 2 - éter pier
eu 3 - chapeu
ia 3 - estória fatia acia praia elogia mania lábia aprecia polícia arredia cheia ásia
ir 3 - freir
iu 3 -
ou 3 -
i 3 -
""")

STEPS = {
    "plural": PLURAL,
    "feminine": FEMININE,
    "augmentative": AUGMENTATIVE,
    "adverb": ADVERB,
    "noun": NOUN,
    "verb": VERB,
    "vowel": VOWEL,
}
