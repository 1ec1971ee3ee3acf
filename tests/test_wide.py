from lectern import fixed_values as fixed
from lectern.plans import wide
from tests.test_operators import rows_of

RECORD = ["RecordReference", "ISBN13", "Título", "Subtítulo", "Colaborador", "Fecha de publicación", "THEMA", "BISAC", "Dewey",
          "Palabras claves", "Texto de contenido", "Editor", "Editores", "Formato", "Idioma", "Colección", "País de publicación",
          "Ciudad de publicación", "DOI"]
TEMPLATE = ["Titulo", "anio_publicacion", "Autor", "Editor", "Compilador", "Coordinador", "palabras_clave", "ISBN IMPRESO", "ISBN PDF",
            "ISBN EPUB", "DOI", "pais_publicacion", "ciudad_publicacion", "editorial_principal_nombre", "coedicion_si_no",
            "institucion_coeditora_nombre", "tipo_coedicion", "tipo_obra", "resumen", "idioma", "coleccion", "bisac", "thema", "dewey"]
SERIAL = ["_id", "eisbn", "isbn", "title", "publication_date", "creators", "country", "publisher", "synopsis", "language", "collection",
          "bisac_code", "TYPE", "doi_number", "edition", "shopping_info"]


def table(spark, columns, rows):
    data = [tuple([n, "f.csv", *[row.get(c) for c in columns]]) for n, row in enumerate(rows, start=2)]
    return spark.createDataFrame(data, ", ".join(["row long", "origin_file string", *[f"`{c}` string" for c in columns]]))


def build(spark):
    records = table(spark, RECORD, [
        {"RecordReference": "R1", "ISBN13": "9780000000001.0", "Título": "Uno", "Subtítulo": "sub", "Colaborador": "Ana | Luz ;Ana",
         "Fecha de publicación": "03/04/2021", "THEMA": "[JN] Educación; [JN] Otra", "BISAC": "[EDU000000] x", "Editor": "Casa",
         "Editores": "CASA; Socia (MX)", "Formato": "print", "Idioma": "Español / Castellano", "Texto de contenido": " a  b "},
        {"THEMA": "[QD] Filosofía"},
        {"Texto de contenido": "c"},
        {},
        {"RecordReference": "R2", "ISBN13": "9780000000001", "Título": "Uno", "Colaborador": "Ana", "Fecha de publicación": "2022",
         "Editor": "Casa", "DOI": "10.1/uno"},
        {"RecordReference": "R3", "ISBN13": "123", "Título": "Malo", "Colaborador": "Zoe", "Fecha de publicación": "2022", "Editor": "Casa"},
        {"RecordReference": "R4", "Título": "Viejo", "Colaborador": "Zoe", "Fecha de publicación": "1999", "Editor": "Casa"},
        {"RecordReference": "R5", "Título": " ", "Colaborador": "Eva", "Fecha de publicación": "2020", "Editor": "Casa"},
    ])
    template = table(spark, TEMPLATE, [
        {"Titulo": "Dos", "anio_publicacion": "2023", "Autor": "Ruiz, Ana ; Luz", "Compilador": "Gil, Eva", "ISBN IMPRESO": "9780000000002.0",
         "ISBN EPUB": "9790000000003", "DOI": "https://doi.org/10.1/dos", "editorial_principal_nombre": "Casa", "coedicion_si_no": "Sí",
         "institucion_coeditora_nombre": "Socia", "pais_publicacion": "Peru", "tipo_obra": "Monograph", "bisac": "HIS000000 > x", "dewey": "[370.7] y"},
        {"Titulo": "Sin nadie", "anio_publicacion": "2023", "ISBN PDF": "9780000000009"},
        {"Titulo": "Tarde", "anio_publicacion": "2025", "Autor": "A", "ISBN PDF": "9780000000008"},
        {"Titulo": "Repetido", "anio_publicacion": "2020", "Autor": "Nueva", "ISBN PDF": "9780000000001", "coedicion_si_no": "no",
         "institucion_coeditora_nombre": "X", "editorial_principal_nombre": "Otra"},
    ])
    serial = table(spark, SERIAL, [
        {"_id": "s1", "eisbn": "9780000000004", "title": "Tres", "publication_date": "2024-05-06", "publisher": "Red", "language": "pt",
         "creators": "[[['role', 'organizer'], ['full_name', 'Backes, Carmen'], ['x', None]], [['role', 'translator'], ['full_name', 'Luz']]]",
         "collection": "[['id', None], ['title', 'Serie']]", "bisac_code": "[[['code', 'SOC000000']]]", "doi_number": "http://dx.doi.org/10.7/t",
         "shopping_info": "[[['store', 'Amazon']], [['store', 'Kobo Books']], [['store', 'Amazon']]]"},
        {"_id": "s2", "isbn": "9780000000005", "title": "Cuatro", "publication_date": "2019-05-06"},
        {"_id": "s3", "title": "Cinco", "publication_date": "2021-05-06"},
    ])
    return wide.WideModel({"simeh": wide.clean_record_export(records), "plantilla_propia": wide.clean_template(template),
                           "scielo": wide.clean_serial_export(serial)})


def test_wide_model(spark):
    built = build(spark)
    found = {row.isbn13: row for row in built.identifiers.collect()}
    assert sorted(found) == ["9780000000001", "9780000000002", "9780000000004", "9790000000003"]
    uno = found["9780000000001"]
    assert (uno.title, uno.year, uno.contributors, uno.thema, uno.summary) == ("Uno: sub", "2021;2022", "Ana;Luz", "JN;JN;QD", "a b c")
    assert (uno.copublisher, uno.shared, uno.edition_format, uno.language, uno.bisac, uno.doi_simeh) == (
        "Socia", "si", "impreso", "Español", "EDU000000", "10.1/uno")
    assert (found["9790000000003"].doi, found["9780000000002"].doi) == ("10.1/dos", None)
    assert (found["9780000000002"].country, found["9780000000002"].work_type, found["9780000000002"].edition_format) == ("Perú", "monografia", "impreso")
    assert (found["9780000000004"].collection, found["9780000000004"].bisac, found["9780000000004"].language) == ("Serie", "SOC000000", "Portugués")
    assert rows_of(built.rejected, "isbn13", "title") == [("123", "Malo"), (fixed.MISSING_ISBN, fixed.MISSING_TITLE)]
    names = {row.author_id: row.name for row in built.authors.collect()}
    roles = {(row.isbn13, names[row.author_id], row.role) for row in built.identifier_authors.collect()}
    assert ("9780000000001", "Nueva", "autor") in roles  # the ignored row still brings its author
    assert ("9780000000004", "Carmen Backes", "compilador") in roles and ("9780000000004", "Luz", "traductor") in roles
    assert ("9780000000002", "Eva Gil", "compilador") in roles and "Zoe" not in names.values()
    assert names[1] == "Ana" and names[2] == "Luz"
    houses = {row.publisher_id: row.name for row in built.publishers.collect()}
    links = {(row.isbn13, houses[row.publisher_id], row.role) for row in built.identifier_publishers.collect()}
    assert {("9780000000001", "Casa", "editor"), ("9780000000001", "Socia", "coeditor"), ("9780000000001", "Otra", "editor")} <= links
    assert rows_of(built.store_sales, "isbn13", "store") == [("9780000000004", "AMAZON.COM"), ("9780000000004", "KOBO.COM")]
    assert {(row.title) for row in built.works.collect()} == {"Uno: sub", "Dos", "Repetido", "Tres"}
    assert built.work_authors.count() == 2 + 3 + 1 + 2
    work = {row.title: row.work_id for row in built.works.collect()}
    matches = spark.createDataFrame([(work["Tres"], "found", "10.9/x", 5), (work["Dos"], "not found", None, None)],
                                    "work_id long, consulted string, doi string, citations long")
    final = built.with_matches(matches)
    dois = {row.isbn13: (row.doi, row.citations) for row in final.collect()}
    assert dois == {"9780000000001": ("10.1/uno", None), "9780000000002": (None, None), "9790000000003": ("10.1/dos", None),
                    "9780000000004": ("10.9/x", 5)}
    counts = {row.name: row.identifiers_with_doi for row in built.publisher_doi_counts(final).collect()}
    assert counts == {"Casa": 2, "Socia": 0, "Otra": 0, "Red": 1}


def test_undated_continuations_can_be_dropped(spark):
    rows = table(spark, RECORD, [
        {"RecordReference": "R1", "ISBN13": "9780000000001", "Título": "Uno", "Colaborador": "Ana", "Fecha de publicación": "2021", "THEMA": "[A] x", "Editor": "C"},
        {"THEMA": "[B] y"}])
    assert rows_of(wide.clean_record_export(rows), "thema") == [("A;B",)]
    assert rows_of(wide.clean_record_export(rows, filter_first=True), "thema") == [("A",)]
