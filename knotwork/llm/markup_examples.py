"""The labelled table on which the block classifier is trained.

Each example is a small text whose lines carry labels: H heading, L list, C code block, F formula, M any other markup,
and nothing for plain text. Labels may be combined. A line of a region (code, nowiki, comment) repeats the region's label.
All texts are written for this table.
"""

EXAMPLES: list[list[tuple[str, str]]] = [
    # wiki
    [("== History ==", "H"), ("The mill was built by three brothers in the last century.", ""), ("=== Early years ===", "H"), ("It burned down twice.", "")],
    [("==Geography==", "H"), ("* north bank", "L"), ("* south bank", "L"), ("** lower meadow", "L"), ("The river divides the town in two parts of equal size.", "")],
    [("Goods made there:", ""), ("#first sort", "L"), ("#second sort", "L"), ("#third sort", "L"), ("Most were sold abroad.", "")],
    [("# flour", "L"), ("# oats", "L"), ("# barley", "L"), ("==== ''Trade'' ====", "H"), ("Trade grew [[slowly]] in those years.", "M")],
    [("A list of words follows this line of the text.", ""), ("# wheel", "L"), ("# axle", "L"), ("", ""), ("Each of them is explained below in more detail.", "")],
    [("; mast : a tall pole", "L"), ("; sail : a sheet of cloth", "L"), ("Both are needed on a ship of that size.", "")],
    [("'''Oak''' is a tree of the northern half of the world.", "M"), ("It is ''very'' old and {{cite|book|12}} much loved.", "M"), ("[[Category:Trees]]", "M")],
    [("#REDIRECT [[Other page]]", "M")], [("#REDIRECT [[Oak]]", "M")], [("# REDIRECT [[Old mill]]", "M"), ("", ""), ("[[Category:Mills]]", "M")], [("#redirect: [[Other page#Part]]", "M"), ("{{R from title}}", "M")],
    [("{{Infobox town", "M"), ("| name = Harl", "M"), ("| size = 12", "M"), ("}}", "M"), ("Harl is a town on the coast of the eastern sea.", "")],
    [('{| class="x"', "M"), ("! head", "M"), ("|-", "M"), ("| 12", "M"), ("|}", "M"), ("The table above has the figures of the year.", "")],
    [("[[File:map.png|thumb|a map]]", "M"), ("The map shows the old walls of the town and the gate.", "")],
    [("The length is <math>a^2</math> by the rule of the right angle.", "FM"), ("Another is {{math|x + y}} in the text.", "FM")],
    [('<math display="block">\\frac{a}{b}</math>', "FM"), ("The value falls as the second one grows larger.", "")],
    [("<nowiki>* no list</nowiki> stands here as an example of the sign.", "M")], [("<nowiki>== no heading ==</nowiki>", "M"), ("Plain words follow.", "")],
    [("<!-- * hidden -->The lake is deep and cold in every season.", "M")], [("The lake is deep.<ref>page 4</ref>", "M"), ("[http://a.example/ more] on the site", "M")],
    [('<source lang="c">\nint a = 1;\n</source>', "CM"), ("The code above sets a value before it is used.", "")],
    [("<syntaxhighlight lang='py'>\n# remark\nx = 1\n</syntaxhighlight>", "CM"), ("== Use ==", "H")],
    [("== Half heading", "H"), ("The closing signs were forgotten by the writer of it.", "")],
    [("[[broken link", "M"), ("was never closed by the author of the page.", "")], [("Some '''bold text without an end", "M")],
    [("Only one was left:", ""), ("", ""), ("* the lone mill", "L"), ("", ""), ("It was sold in the end.", "")], [("*lone item", "L"), ("The rest is lost.", "")], [("; mast : a pole", "L"), ("", ""), ("It stood on deck.", "")],
    [("- lone dash item", "L"), ("", ""), ("Plain words.", "")], [("1. lone number", "L"), ("", ""), ("Plain words.", "")], [("+ lone plus", "L")], [("'''Oak'''", "M"), ("'''Elm'''", "M")], [("; mast : a pole", "L"), ("; sail : cloth", "L")],
    [("The gate was rebuilt twice, and its towers were joined to the wall of the old town.", ""), ("", ""), ("# gate of the town", "L"), ("# tower of stone", "L")], [("The gate was rebuilt twice.", ""), ("", ""), ("# wall", "L"), ("# ditch", "L"), ("", ""), ("Neither of them stands today.", "")],
    [("# bell of bronze", "L"), ("# clock of the hall", "L")], [("# wall of the upper garden", "L"), ("# path", "L"), ("", ""), ("All of it was laid out by one hand in the years after the great fire.", "")],
    # HTML
    [("<h1>Title</h1>", "HM"), ("<p>The first lines of the page are here.</p>", "M"), ("<ul>", "LM"), ("<li>one</li>", "LM"), ("<li>two</li>", "LM"), ("</ul>", "LM")],
    [("<h2>Open heading", "HM"), ("The words go on without a closing tag for it.", "")], [("<H3 class='t'><b>Part</b></H3>", "HM"), ("<ol start=\"2\"><li>x<li>y</ol>", "LM")],
    [("<dl><dt>mast</dt><dd>pole</dd></dl>", "LM"), ("The words were taken from an old book of the sea.<br />", "M")],
    [("<pre>\n== text ==\n</pre>", "CM"), ("It was printed as it stood in the machine's memory.", "")], [("<pre><code>a = b</code></pre>", "CM")],
    [("The word <code>print</code> is used often in such texts.", "M")], [("Fish &amp; chips&nbsp;12 are sold at the harbour &#8211; always.", "M")],
    [("<table><tr><td>4</td></tr></table>", "M"), ('See <a href="http://b.example/">here</a> for more about the town.', "M")],
    [("<math><mi>x</mi><mo>+</mo><mn>1</mn></math> is one more than before.", "FM")], [("<script>var a = 1;</script>", "M"), ("<style>p { color: red }</style>", "M")],
    [("<div class='c'>The island is small.</div>", "M"), ("H<sub>2</sub>O is water and <font color=red>red</font> is a colour.", "M")],
    # Markdown
    [("# Title of the page", "HM"), ("", ""), ("The first words of the page say what it is about.", ""), ("", ""), ("## Part", "HM"), ("### **Bold part** ###", "HM")],
    [("# Overview", "HM"), ("", ""), ("- one", "LM"), ("- two", "LM")], [("Section name", "HM"), ("=====", "HM"), ("Words of the section follow.", "")],
    [("Small section", "HM"), ("-----", "HM"), ("", ""), ("+ plus", "LM"), ("  + deeper", "LM")], [("1. first", "LM"), ("2. second", "LM"), ("3) third", "LM")],
    [("It is *very* old and **quite** large, as `ls` shows.", "M"), ("~~gone~~ and _kept_ words stand in one line here.", "M")],
    [("```python\n# remark\nx = 1\n```", "CM"), ("The code was left as it is by the cleaning of the text.", "")], [("~~~\n* no list\n~~~", "CM")],
    [("> A quoted line of the book that was named before.", "M"), ("![map](a.png)", "M"), ("See [the map](http://c.example/).", "M")],
    [("| a | b |", "M"), ("|---|---|", "M"), ("| 1 | 2 |", "M"), ("The rows are few.", "")],
    [("The sum is $x_1 + y$ in the end of the line.", "FM"), ("$$a^2 + b^2$$", "FM"), ("where $$n_k$$ holds for all.", "FM")],
    [("$$\na = b\n$$", "FM"), ("Both sides are equal for every number that is given.", "")], [("---", "M"), ("The line above divides the parts of the page.", "")],
    # LaTeX
    [("\\section{Start}", "HM"), ("The words of the section are plain here.", ""), ("\\subsection*{More}", "HM"), ("\\paragraph{End}", "HM"), ("\\chapter{One}", "HM")],
    [("\\begin{itemize}", "LM"), ("  \\item one", "LM"), ("  \\item two", "LM"), ("\\end{itemize}", "LM"), ("\\begin{quote}Said before.\\end{quote}", "M")],
    [("\\begin{verbatim}\n== x ==\n\\end{verbatim}", "CM"), ("\\begin{lstlisting}\nint a;\n\\end{lstlisting}", "CM")],
    [("\\begin{equation}\na \\le b\n\\end{equation}", "FM"), ("So \\(n_k\\) and \\[2^n\\] hold in the text.", "FM")],
    [("\\textbf{Oak} is \\emph{old}.~\\cite{k1} See \\ref{a} and \\LaTeX.", "M"), ("% a remark", "M"), ("Words\\footnote{More words.} end.", "M")],
    [("<h2>Open", "HM"), ("</h2>", "HM"), ("The mill stands on the north bank.", "")], [("The word", "HM"), ("====", "HM"), ("", ""), ("---", "M")],
    [("It lies by the sea.<ref name='a'>Said by all.</ref>", "M"), ("Said \\cite{k2} before.", "M"), ("See [[here", "M"), ("It is late &mdash; very late.", "M"), ("{{cite|x|1}}", "M")],
    [("<small>mill", "M")], [("mill<!-- 9 -->", "M")], [("{{nowrap|Oak}}", "M")], [("\\textit{Oak}", "M")], [("'''''Oak'''''", "M")], [("~~Oak~~", "M")], [("Oak $x_1$", "FM")], [("mill {{math|x}}", "FM")], [("[[Oak]]", "M")], [("`Oak`", "M")], [("**Oak**", "M")],
    # plain
    [("The sum is 9 * 7 * 2 in all.", ""), ("It was #4 on the list.", ""), ("It cost $60 in spring and $69 in autumn.", "")],
    [("The path a/river\\48 was lost.", ""), ("The sign == stands for sameness of two things.", ""), ("It holds for a < 12 and b > 13 only.", "")],
    [("See note [31] for more.", ""), ("Smith & sons ran it.", ""), ("The set {a, 85} is small.", ""), ("About ~44 of them, or file_12, were left.", "")],
    [("They wrote f(x) = 10x | x > 0.", ""), ("It grew by ~75 percent; the field road_49_name was empty.", ""), ("Oak: 8 > 7", "")], [("C# bridge", "")], [("<25 Oak>", "")],
    [("Tree #7", "")], [("Oak ~44", "")], [("$58 mill", "")], [("12 < 14", "")], [("mill [38]", "")], [("56 * 58 Oak", "")], [("Oak & sons", "")], [("Oak_12", "")], [("a -- b", "")],
    [("The mill was sold.", ""), ("", ""), ("The bridge was not.", ""), ("", ""), ("Nothing else is known of either; both were old.", "")],
    [("A short line", ""), ("", ""), ("A second short line", ""), ("", ""), ("\"Quoted words\", said one of them in 1640.", "")],
]
