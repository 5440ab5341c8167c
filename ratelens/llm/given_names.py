"""Lexicon of given names by script and gender, by which names without a title are found.

Surrogates come from their own lists in pii. Given names that are also common words at the start of a sentence or
place names (Mark, Will, Grace, Rose, Hope, Paris, Роман, Вера) are left out; with a title they are found all the same.
"""

LEXICON = {
    ("latin", "f"): (
        "Abigail Adriana Agnieszka Alexandra Alice Alicia Amalia Amanda Amelia Amélie Andrea Angela Angelika Anita Anja Anke Ann Anna Anne Annette Antje Aurélie "
        "Barbara Beatriz Berta Birgit Brigitte Camille Carla Carmen Carolina Caroline Catherine Cécile Céline Charlotte Chloé Christina Christine Clara Claire Claudia "
        "Cristina Daniela Deborah Denise Diana Dolores Dominique Donna Dorothea Dorothy Édith Elena Eleanor Élise Elisabeth Elizabeth Élodie Emilia Emily Emma Erika Esther Eva "
        "Evelyn Fatima Florence Franziska Françoise Frieda Gabriela Gabriele Gisela Greta Hannah Heather Heike Helen Helena Helga Hélène Ingrid Ines Inés Irene Isabel Isabella "
        "Isabelle Jacqueline Janet Jana Jennifer Jessica Joana Johanna Josefina Josephine Juana Judith Julia Julie Juliette Karen Karin Katharina Katherine Kathleen Katja "
        "Kimberly Kristina Laura Lea Léa Lena Leonie Linda Lisa Louise Lucia Lucía Lucie Luisa Magdalena Małgorzata Manon Manuela Margaret Margarita Margot Maria María Marie Marina "
        "Marion Marlene Marta Martina Mary Mathilde Melanie Melissa Mercedes Michelle Mónica Monika Monique Nadia Nancy Natalia Nathalie Nicole Nina Nora Olga Olivia Pamela "
        "Patricia Paula Pauline Petra Pilar Rachel Raquel Rebecca Regina Renate Rocío Rosa Rosario Ruth Sabine Samantha Sandra Sara Sarah Silvia Simone Sofia Sofía Solène "
        "Sophia Sophie Stefanie Stephanie Susan Susanne Svetlana Sylvie Teresa Theresa Ursula Valentina Valérie Vanessa Verónica Veronika Victoria Virginie Yolanda Yvonne Zoë Zoé"
    ),
    ("latin", "m"): (
        "Aaron Adam Adrian Adrien Alain Alan Albert Alberto Alejandro Alexander Alexandre Alfonso Alfred Álvaro Andreas Andrés Andrew Ángel Anthony Antoine Antonio Arnaud Arthur "
        "Axel Bastien Benjamin Benoît Bernard Bernd Bernhard Björn Brandon Brian Bruno Carlos Charles Christian Christoph Christophe Christopher Claude Clemens Daniel David Dennis "
        "Didier Diego Dieter Dietmar Dirk Donald Douglas Edgar Eduardo Edward Emil Emilio Emmanuel Enrique Eric Erich Ernst Ethan Étienne Eugene Fabian Federico Felipe Felix "
        "Fernando Florian François Francisco Frank Franz Frédéric Friedrich Gabriel Gary George Georg Gerald Gerhard Gérard Gilles Gonzalo Gregory Guillaume Guillermo Günter Günther "
        "Gustav Gustavo Hans Harald Harold Heinrich Heinz Helmut Henri Henry Herbert Hermann Holger Horst Hugo Ignacio Jacob Jacques Jaime James Jan Jason Javier Jean Jeffrey Jens "
        "Jeremy Jérôme Joachim Joaquín Jochen Johann Johannes John Jonas Jonathan Jorge José Joseph Joshua Juan Julien Julio Jürgen Justin Karl Kenneth Kevin Klaus Konrad Kurt "
        "Lars Laurent Lawrence Leonard Leonardo Louis Luc Lucas Ludwig Luis Lukas Łukasz Manfred Manuel Marc Marcel Marcos Mariano Mario Markus Martin Mateo Mathieu Matthew "
        "Matthias Maurice Maximilian Michael Michel Miguel Mohamed Muhammad Nathan Nicholas Nicolas Nicolás Norbert Olivier Oscar Óscar Otto Pablo Pascal Patrick Paul Pedro Peter "
        "Philip Philipp Philippe Pierre Rafael Rainer Ralf Ramón Raphaël Raúl Raymond Reinhard René Ricardo Richard Robert Roberto Rodrigo Roger Roland Rolf Ronald Rubén "
        "Rudolf Rüdiger Ryan Salvador Samuel Santiago Scott Sebastian Sébastien Sergio Simon Stefan Stephen Steven Sven Thierry Thomas Thorsten Timothy Tobias Ulrich Uwe "
        "Vicente Vincent Walter Werner William Wilhelm Wolfgang Xavier Yves Zachary Émile Éric"
    ),
    ("cyrillic", "f"): (
        "Александра Алёна Алина Алла Анастасия Анна Валентина Валерия Варвара Вероника Виктория Галина Дарья Диана Евгения Екатерина Елена Елизавета Жанна Зинаида Инна Ирина "
        "Кристина Ксения Лариса Лидия Людмила Маргарита Марина Мария Надежда Наталья Нина Оксана Олена Ольга Полина Раиса Светлана София Тамара Татьяна Ульяна Юлия Яна"
    ),
    ("cyrillic", "m"): (
        "Александр Алексей Анатолий Андрей Антон Аркадий Артём Борис Вадим Валерий Василий Виктор Виталий Владимир Владислав Вячеслав Геннадий Георгий Григорий Даниил Денис Дмитрий "
        "Евгений Егор Иван Игорь Илья Кирилл Константин Леонид Максим Михаил Никита Николай Олег Павел Пётр Петро Руслан Сергей Станислав Степан Тарас Тимофей Фёдор Юрий Яков Ярослав"
    ),
    ("greek", "f"): "Αγγελική Αικατερίνη Άννα Αναστασία Βασιλική Γεωργία Δέσποινα Ειρήνη Ελένη Ευαγγελία Ιωάννα Κατερίνα Κωνσταντίνα Μαρία Παναγιώτα Σοφία Χριστίνα",
    ("greek", "m"): "Αθανάσιος Αλέξανδρος Ανδρέας Αντώνης Βασίλης Γεώργιος Γιάννης Γιώργος Δημήτρης Ιωάννης Κώστας Κωνσταντίνος Μιχάλης Νίκος Νικόλαος Παναγιώτης Παύλος Πέτρος Σπύρος Χρήστος",
}
NAMES = {key: tuple(dict.fromkeys(names.split())) for key, names in LEXICON.items()}


def of(gender: str) -> tuple[str, ...]:
    """All names of a gender, of any script."""
    return tuple(n for (_, g), names in NAMES.items() if g == gender for n in names)


def pattern(names: tuple[str, ...]) -> str:
    """A pattern for any of the names, by first letter, so that most words fail at once."""
    by_first: dict[str, list[str]] = {}
    for n in names:
        by_first.setdefault(n[0], []).append(n[1:])
    return "|".join(f"{a}(?:{'|'.join(sorted(rest, reverse=True))})" for a, rest in sorted(by_first.items()))
